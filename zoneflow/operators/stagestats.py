"""Stage attempts and tasks of many runs, rolled up to one metrics row per phase."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.operators.quantiles import Quantile, summarise
from zoneflow.operators.runlog import block_text
from zoneflow.sources.workdir import materialise

RUN_STAGE = ["run", "stage_id"]
PHASE_KEYS = ["run", "phase"]


def event_tasks(events: DataFrame) -> DataFrame:
    """``run, stage_id, attempt_id, ok, failed, run_ms, write_bytes, read_bytes`` per ended task."""
    m = F.col("Task Metrics")
    read = m["Shuffle Read Metrics"]
    ok = F.col("Task End Reason")["Reason"] == "Success"
    zero = lambda c: F.coalesce(c, F.lit(0))
    return events.filter(F.col("Event") == "SparkListenerTaskEnd").select(
        "run",
        F.col("Stage ID").alias("stage_id"),
        F.col("Stage Attempt ID").alias("attempt_id"),
        ok.alias("ok"),
        (F.col("Task Info")["Failed"] & ~ok).alias("failed"),
        m["Executor Run Time"].alias("run_ms"),
        zero(m["Shuffle Write Metrics"]["Shuffle Bytes Written"]).alias("write_bytes"),
        (zero(read["Remote Bytes Read"]) + zero(read["Local Bytes Read"])).alias("read_bytes"),
    )


def event_attempts(events: DataFrame) -> DataFrame:
    """One row per stage attempt that ended, with the sums of its tasks."""
    info = F.col("Stage Info")
    ended = events.filter(F.col("Event") == "SparkListenerStageCompleted").select(
        "run",
        info["Stage ID"].alias("stage_id"),
        info["Stage Attempt ID"].alias("attempt_id"),
        info["Number of Tasks"].alias("num_tasks"),
        F.when(info["Failure Reason"].isNull(), "COMPLETE").otherwise("FAILED").alias("status"),
    )
    keys = [*RUN_STAGE, "attempt_id"]
    sums = event_tasks(events).groupBy(*keys).agg(
        F.count_if("ok").alias("num_complete_tasks"),
        F.count_if("failed").alias("num_failed_tasks"),
        F.sum("write_bytes").alias("shuffle_write_bytes"),
        F.sum("read_bytes").alias("shuffle_read_bytes"),
    )
    return ended.join(sums, keys, "left")


def job_starts(events: DataFrame) -> DataFrame:
    """``run, job_id, phase, started_ms, stage_ids`` per started job; the job group names the phase."""
    return events.filter(F.col("Event") == "SparkListenerJobStart").select(
        "run",
        F.col("Job ID").alias("job_id"),
        F.col("Properties")["spark.jobGroup.id"].alias("phase"),
        F.col("Submission Time").alias("started_ms"),
        F.col("Stage IDs").alias("stage_ids"),
    )


def event_jobs(events: DataFrame) -> DataFrame:
    """``run, job_id, phase, started_ms, stage_ids, ended_ms`` per job: the started jobs with their ends."""
    end = events.filter(F.col("Event") == "SparkListenerJobEnd").select(
        "run", F.col("Job ID").alias("job_id"), F.col("Completion Time").alias("ended_ms")
    )
    return job_starts(events).join(end, ["run", "job_id"], "left")


def stage_phases(jobs: DataFrame) -> DataFrame:
    """``run, stage_id, phase``: the phase of the job that first listed the stage, which ran it. Ends of jobs are not asked for."""
    listed = jobs.select("run", "phase", "started_ms", F.explode("stage_ids").alias("stage_id"))
    return listed.groupBy(*RUN_STAGE).agg(F.min_by("phase", F.struct("started_ms", "phase")).alias("phase"))


def phase_spans(jobs: DataFrame) -> DataFrame:
    """``job_span_s`` and ``ended_at_epoch_s`` per phase: first job start to last job end.

    The span leaves out driver time before the first and after the last job.
    """
    seconds = lambda ms: F.round(ms / 1000, 1)
    return jobs.groupBy(*PHASE_KEYS).agg(
        seconds(F.max("ended_ms") - F.min("started_ms")).alias("job_span_s"),
        seconds(F.max("ended_ms")).alias("ended_at_epoch_s"),
    )


def busy_times(jobs: DataFrame) -> DataFrame:
    """``busy_s, idle_s, n_islands`` per phase: the time in which at least one of its jobs ran, and the gaps between.

    Unlike the span, this leaves out time in which only other phases ran. Jobs are taken in order of their start; a job that
    starts after all before it have ended begins a new island. Jobs without an end, or with one before their start, count
    for nothing. Touching jobs are one island.
    """
    real = jobs.filter("ended_ms >= started_ms").select(*PHASE_KEYS, "started_ms", "ended_ms")
    order = Window.partitionBy(*PHASE_KEYS).orderBy("started_ms", "ended_ms")
    before = F.max("ended_ms").over(order.rowsBetween(Window.unboundedPreceding, -1))
    # what a job adds to the time covered by all that started earlier
    rows = real.withColumn("before", before)
    begins = F.col("before").isNull() | (F.col("started_ms") > F.col("before"))
    adds = F.greatest(F.lit(0), F.col("ended_ms") - F.greatest("started_ms", F.coalesce("before", "started_ms")))
    seconds = lambda ms: F.round(ms / 1000, 1)
    return rows.select(*PHASE_KEYS, begins.alias("begins"), adds.alias("adds"), "started_ms", "ended_ms").groupBy(*PHASE_KEYS).agg(
        seconds(F.sum("adds")).alias("busy_s"),
        seconds(F.max("ended_ms") - F.min("started_ms") - F.sum("adds")).alias("idle_s"),
        F.count_if("begins").alias("n_islands"),
    )


def run_nodes(events: DataFrame) -> DataFrame:
    """``run, n_executors, nodes``: executors a run gained and the hosts they were on, from its event log."""
    added = events.filter(F.col("Event") == "SparkListenerExecutorAdded").select("run", "Executor ID", F.col("Executor Info")["Host"].alias("host"))
    # one row per executor and host first, so that a long log is not one group
    each = added.groupBy("run", "host").agg(F.count_distinct("Executor ID").alias("n"))
    return each.groupBy("run").agg(F.sum("n").alias("n_executors"), F.count("host").alias("nodes"))


def with_defaults(attempts: DataFrame) -> DataFrame:
    """Attempt records with optional fields absent or null: attempt 0, COMPLETE, zero counts."""
    zeros = ["attempt_id", "num_failed_tasks", "num_complete_tasks", "num_tasks", "shuffle_write_bytes", "shuffle_read_bytes"]
    col = lambda c: F.col(c) if c in attempts.columns else F.lit(None)
    others = [c for c in attempts.columns if c not in zeros and c != "status"]
    return attempts.select(
        *others,
        F.coalesce(col("status").cast("string"), F.lit("COMPLETE")).alias("status"),
        *(F.coalesce(col(c).cast("long"), F.lit(0)).alias(c) for c in zeros),
    )


def not_seen_before(attempts: DataFrame, before: DataFrame) -> DataFrame:
    """Attempts of stages that were not complete yet when the phase began."""
    return attempts.join(before.select(*RUN_STAGE).distinct(), RUN_STAGE, "left_anti")


def latest_attempts(attempts: DataFrame) -> DataFrame:
    """One row per stage: its highest attempt, and whether anything about the stage was retried.

    Sums over attempts would count a resubmitted stage twice.
    """
    a = with_defaults(attempts)
    fields = [c for c in a.columns if c not in RUN_STAGE]
    latest = a.groupBy(*RUN_STAGE).agg(
        F.max_by(F.struct(*fields), "attempt_id").alias("latest"),
        F.count(F.lit(1)).alias("n_attempts"),
        F.bool_or(F.col("status") != "COMPLETE").alias("any_incomplete"),
    )
    retried = (F.col("n_attempts") > 1) | F.col("any_incomplete") | (F.col("latest.num_failed_tasks") > 0)
    return latest.select(*RUN_STAGE, "latest.*", "n_attempts", retried.alias("retried"))


def task_quantiles(tasks: DataFrame, chunks: int | None = None) -> DataFrame:
    """Least, middle and greatest run time of the successful tasks of each stage attempt.

    The middle is the sorted element at ``floor(n / 2)``; it is not interpolated. ``chunks``: see ``summarise``.
    """
    return summarise(
        tasks.filter("ok").select(*RUN_STAGE, "attempt_id", F.col("run_ms").cast("double").alias("run_ms")),
        [*RUN_STAGE, "attempt_id"],
        [F.min("run_ms").alias("min_ms"), F.max("run_ms").alias("max_ms")],
        [Quantile("med_ms", "run_ms", 0.5, method="index")],
        chunks,
    )


def retried_stages(latest: DataFrame) -> DataFrame:
    """The stages behind a retry flag, one row each, with the latest attempt's failed tasks."""
    return latest.filter("retried").select(*RUN_STAGE, "phase", "n_attempts", "num_failed_tasks")


def phase_rollup(latest: DataFrame, quantiles: DataFrame) -> DataFrame:
    """One row per run and phase from latest attempts (with ``phase``) and task quantiles.

    ``partitions`` is read off the stages that consume a shuffle; a phase without one reports its
    widest stage. ``task_med_s`` is the largest stage median. Stages without quantiles are skipped
    in the task times only.
    """
    s = latest.join(quantiles, [*RUN_STAGE, "attempt_id"], "left")
    n = F.col("num_tasks")
    seconds = lambda ms: F.round(F.coalesce(ms, F.lit(0.0)) / 1000, 1)
    return s.groupBy(*PHASE_KEYS).agg(
        F.sum("shuffle_write_bytes").alias("shuffle_write_bytes"),
        F.coalesce(F.max(F.when(F.col("shuffle_read_bytes") > 0, n)), F.max(n)).alias("partitions"),
        F.sum("num_complete_tasks").alias("tasks"),
        F.max(F.col("retried").cast("int")).alias("retried"),
        F.count_if("retried").alias("n_retried_stages"),
        seconds(F.min("min_ms")).alias("task_min_s"),
        seconds(F.max("med_ms")).alias("task_med_s"),
        seconds(F.max("max_ms")).alias("task_max_s"),
    )


def with_degraded(phases: DataFrame, rollup: DataFrame, keys: Sequence[str] = PHASE_KEYS) -> DataFrame:
    """Every phase gets a row: zeros and ``mode=degraded`` where no stage metrics could be read.

    Work outside any named phase has a null phase, which is a phase like the others. Measured phases without a
    job in the log (it may have been rolled) keep their numbers and have no span.
    """
    measured, given = [c for c in rollup.columns if c not in keys], [c for c in phases.columns if c not in keys]
    left, right = phases.withColumn("__known", F.lit(True)).alias("l"), rollup.withColumn("__seen", F.lit(True)).alias("r")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    out = left.join(right, same, "full")
    return out.select(
        *(F.when(F.col("__known"), F.col(f"l.{k}")).otherwise(F.col(f"r.{k}")).alias(k) for k in keys),
        *(F.col(f"l.{c}").alias(c) for c in given),
        F.when(F.col("__seen"), "rest").otherwise("degraded").alias("mode"),
        *(F.coalesce(F.col(f"r.{c}"), F.lit(0).cast(rollup.schema[c].dataType)).alias(c) for c in measured),
    )


def rollup_events(events: DataFrame) -> DataFrame:
    """Event log to phase rows. The events are stored once, so the log text is parsed once."""
    events = materialise(events)
    latest = latest_attempts(event_attempts(events).join(stage_phases(job_starts(events)), RUN_STAGE, "left"))
    rollup = phase_rollup(latest, task_quantiles(event_tasks(events)))
    return with_degraded(phase_spans(event_jobs(events)), rollup)


# What a phase's metrics block holds, in order, and where a rollup row has it.
PHASE_BLOCK = {
    "wall_s": "job_span_s",
    "shuffle_write_bytes": "shuffle_write_bytes",
    "partitions": "partitions",
    "tasks": "tasks",
    "retried": "retried",
    "task_min_s": "task_min_s",
    "task_med_s": "task_med_s",
    "task_max_s": "task_max_s",
    "ended_at_epoch_s": "ended_at_epoch_s",
    "rest_target": "rest_target",
    "shuffle_partitions": "shuffle_partitions",
}


def phase_blocks(rollup: DataFrame, platform: str, stage: str, shuffle_partitions: int, rest_target: str = "event-log") -> DataFrame:
    """``run, text``: the metrics block of every rolled-up phase, as run logs hold it.

    The wall time is the job span; a phase without a span, or without a name, says ``None``.
    """
    known = rollup.withColumns({"rest_target": F.lit(rest_target), "shuffle_partitions": F.lit(shuffle_partitions)})
    header = {"mode": F.col("mode"), "platform": F.lit(platform), "stage": F.lit(stage), "phase": F.col("phase")}
    return known.select("run", block_text(header, {k: F.col(c) for k, c in PHASE_BLOCK.items()}).alias("text"))
