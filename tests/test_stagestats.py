import subprocess
import sys

import pytest

from zoneflow.operators import stagestats as ss
from zoneflow.sources import logs

ATTEMPT = (
    "run string, phase string, stage_id long, attempt_id long, status string, num_failed_tasks long, "
    "num_complete_tasks long, num_tasks long, shuffle_write_bytes long, shuffle_read_bytes long"
)
TIMES = "run string, stage_id long, attempt_id long, min_ms double, max_ms double, med_ms double"


def rollup(spark, attempts, times=()):
    latest = ss.latest_attempts(spark.createDataFrame([("r", "A", *a) for a in attempts], ATTEMPT))
    quantiles = spark.createDataFrame([("r", *t) for t in times], TIMES)
    rows = ss.phase_rollup(latest, quantiles).collect()
    assert len(rows) == 1
    return rows[0], {r.stage_id: r.num_failed_tasks for r in ss.retried_stages(latest).collect()}


def test_single_attempts(spark):
    r, bad = rollup(
        spark,
        [(1, 0, "COMPLETE", 0, 10, 10, 500, 0), (2, 0, "COMPLETE", 0, 16, 16, 7, 400)],
        [(1, 0, 100.0, 2000.0, 900.0), (2, 0, 50.0, 9000.0, 3000.0)],
    )
    assert (r.shuffle_write_bytes, r.partitions, r.tasks, r.retried, r.n_retried_stages) == (507, 16, 26, 0, 0)
    assert (r.task_min_s, r.task_med_s, r.task_max_s) == (0.1, 3.0, 9.0)
    assert bad == {}


def test_resubmitted_stage_counts_once(spark):
    r, bad = rollup(
        spark,
        [(1, 0, "COMPLETE", 0, 64, 64, 5000, 0), (2, 0, "FAILED", 3, 40, 64, 0, 90), (2, 1, "COMPLETE", 0, 14, 14, 0, 20)],
    )
    assert (r.shuffle_write_bytes, r.partitions, r.tasks, r.retried) == (5000, 14, 78, 1)
    assert bad == {2: 0}


def test_failed_tasks_inside_one_attempt(spark):
    r, bad = rollup(spark, [(1, 0, "COMPLETE", 4, 10, 10, 1, 0), (3, 0, "COMPLETE", 0, 2, 2, 1, 0)])
    assert r.retried == 1 and r.n_retried_stages == 1 and bad == {1: 4}


def test_status_alone_marks_a_retry(spark):
    r, bad = rollup(spark, [(1, 0, "FAILED", 0, 10, 10, 1, 0)])
    assert r.retried == 1 and bad == {1: 0}


def test_no_shuffle_reader_reports_the_widest_stage(spark):
    r, _ = rollup(spark, [(1, 0, "COMPLETE", 0, 60, 60, 0, 0), (2, 0, "COMPLETE", 0, 3, 3, 0, 0)])
    assert r.partitions == 60


def test_missing_fields_and_times(spark):
    df = spark.createDataFrame([("r", "A", 1), ("r", "A", 2)], "run string, phase string, stage_id long")
    latest = ss.latest_attempts(df)
    r = ss.phase_rollup(latest, spark.createDataFrame([], TIMES)).first()
    assert (r.shuffle_write_bytes, r.partitions, r.tasks, r.retried) == (0, 0, 0, 0)
    assert (r.task_min_s, r.task_med_s, r.task_max_s) == (0.0, 0.0, 0.0)


def test_stage_without_times_is_skipped_in_times_only(spark):
    r, _ = rollup(
        spark,
        [(1, 0, "COMPLETE", 0, 5, 5, 10, 0), (2, 0, "COMPLETE", 0, 5, 5, 10, 0)],
        [(2, 0, 200.0, 400.0, 300.0)],
    )
    assert (r.tasks, r.task_min_s, r.task_med_s, r.task_max_s) == (10, 0.2, 0.3, 0.4)


@pytest.mark.parametrize("chunks", [1, 9])
def test_middle_task_is_not_interpolated(spark, chunks):
    rows = [("r", 1, 0, True, ms) for ms in (40, 10, 30, 20)] + [("r", 2, 0, True, ms) for ms in (5, 1, 9)]
    rows += [("r", 1, 0, False, 1), ("r", 3, 0, True, 8)]
    tasks = spark.createDataFrame(rows, "run string, stage_id long, attempt_id long, ok boolean, run_ms long")
    out = {r.stage_id: (r.min_ms, r.med_ms, r.max_ms) for r in ss.task_quantiles(tasks, chunks).collect()}
    assert out == {1: (10.0, 30.0, 40.0), 2: (1.0, 5.0, 9.0), 3: (8.0, 8.0, 8.0)}


def test_only_new_stages(spark):
    rows = [("r", "A", i, 0, "COMPLETE", 0, 1, 1, 0, 0) for i in (1, 2, 3)]
    before = spark.createDataFrame([("r", 1), ("r", 1), ("q", 2)], "run string, stage_id long")
    kept = ss.not_seen_before(spark.createDataFrame(rows, ATTEMPT), before)
    assert sorted(r.stage_id for r in kept.collect()) == [2, 3]


def test_degraded_phase_reports_zeros(spark):
    phases = spark.createDataFrame([("r", "A"), ("r", "B")], "run string, phase string")
    latest = ss.latest_attempts(spark.createDataFrame([("r", "A", 1, 0, "COMPLETE", 0, 2, 2, 9, 0)], ATTEMPT))
    roll = ss.phase_rollup(latest, spark.createDataFrame([], TIMES))
    out = {r.phase: r for r in ss.with_degraded(phases, roll).collect()}
    assert out["A"]["mode"] == "rest" and out["A"].tasks == 2
    assert out["B"]["mode"] == "degraded" and (out["B"].tasks, out["B"].task_max_s, out["B"].retried) == (0, 0.0, 0)


JOB = """
import sys
from pyspark.sql import SparkSession
s = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
     .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", sys.argv[1])
     .config("spark.sql.shuffle.partitions", "16")
     .config("spark.sql.adaptive.coalescePartitions.enabled", "false").getOrCreate())
s.sparkContext.setJobGroup("A_aggregate", "")
s.range(0, 10000, 1, 4).selectExpr("id % 50 AS k").groupBy("k").count().write.format("noop").mode("overwrite").save()
s.sparkContext.setJobGroup("B_fit", "")
s.sparkContext.parallelize(range(60), 60).map(lambda x: x * x).collect()
s.stop()
"""


@pytest.fixture(scope="module")
def real_log(tmp_path_factory):
    """A folder with a log as the engine writes it by default: rolled and compressed."""
    folder = tmp_path_factory.mktemp("events")
    subprocess.run([sys.executable, "-c", JOB, str(folder)], check=True, capture_output=True, timeout=300)
    return folder


def test_real_event_log(spark, real_log):
    events = logs.read_event_log(spark, str(real_log))
    assert {(r.run.split("/")[-1], r.app_id, r.part) for r in events.collect()} == {(f.name, f.name.removeprefix("eventlog_v2_"), 1) for f in real_log.iterdir()}
    out = {r.phase: r for r in ss.rollup_events(events).collect()}
    a, b = out["A_aggregate"], out["B_fit"]
    assert a.partitions == 16 and a.tasks == 20 and a.shuffle_write_bytes > 0
    assert b.partitions == 60 and b.tasks == 60 and b.shuffle_write_bytes == 0
    for r in (a, b):
        assert r["mode"] == "rest" and r.retried == 0 and r.job_span_s >= 0
        assert 0 <= r.task_min_s <= r.task_med_s <= r.task_max_s
    assert b.ended_at_epoch_s >= a.ended_at_epoch_s


def test_parts_of_a_log_are_one_run(spark, real_log, tmp_path):
    """The real lines dealt to parts, plain and compacted, beside another application's single file."""
    lines = spark.read.text([str(p) for p in real_log.rglob("events_1_*")])
    lines = [r.value for r in lines.collect()]
    folder = tmp_path / "eventlog_v2_app-1"
    folder.mkdir()
    cut = [lines[i::3] for i in range(3)]
    for i, part in enumerate(cut):
        (folder / f"events_{i + 1}_app-1").write_text("\n".join(part))
    (folder / "events_2_app-1.compact").write_text("\n".join(cut[0] + cut[1]))
    (folder / "appstatus_app-1").write_text("")
    (tmp_path / "app-2").write_text("\n".join(lines))
    events = logs.read_event_log(spark, str(tmp_path))
    by_run = {}
    for r in ss.rollup_events(events).collect():
        by_run.setdefault(r.run.split("/")[-1], []).append(tuple(r)[1:])
    assert set(by_run) == {"eventlog_v2_app-1", "app-2"}
    assert sorted(by_run["eventlog_v2_app-1"], key=str) == sorted(by_run["app-2"], key=str)
    assert {(r.run.split("/")[-1], r.part) for r in events.select("run", "part").distinct().collect()} == {
        ("eventlog_v2_app-1", 2), ("eventlog_v2_app-1", 3), ("app-2", 1)
    }
    assert events.filter("app_id IS NULL").count() == 0
    assert {r.nodes for r in ss.run_nodes(events).collect()} == {1}


def test_busy_time_leaves_gaps_out(spark):
    rows = [("A", 0, 1000), ("A", 500, 700), ("A", 900, 2000), ("B", 2000, 5000), ("A", 5000, 6000), ("A", 6000, 6000), ("A", 7000, None), (None, 0, 100)]
    jobs = spark.createDataFrame([("r", *x) for x in rows], "run string, phase string, started_ms long, ended_ms long")
    out = {r.phase: (r.busy_s, r.idle_s, r.n_islands) for r in ss.busy_times(jobs).collect()}
    assert out == {"A": (3.0, 3.0, 2), "B": (3.0, 0.0, 1), None: (0.1, 0.0, 1)}
    assert ss.busy_times(jobs.limit(0)).collect() == []


def test_ends_of_jobs_are_joined_once(spark):
    """Phases of stages need the starts only, so a rollup reads the ends for the spans and for nothing else."""
    lines = [
        '{"Event":"SparkListenerJobStart","Job ID":1,"Submission Time":1000,"Stage IDs":[7],"Properties":{"spark.jobGroup.id":"A"}}',
        '{"Event":"SparkListenerJobStart","Job ID":2,"Submission Time":3000,"Stage IDs":[7,8],"Properties":{}}',
        '{"Event":"SparkListenerJobEnd","Job ID":1,"Completion Time":2000}',
        '{"Event":"SparkListenerJobEnd","Job ID":1,"Completion Time":2500}',
        '{"Event":"SparkListenerStageCompleted","Stage Info":{"Stage ID":7,"Stage Attempt ID":0,"Number of Tasks":3}}',
        '{"Event":"SparkListenerStageCompleted","Stage Info":{"Stage ID":8,"Stage Attempt ID":0,"Number of Tasks":5}}',
    ]
    events = logs.parse_events(spark.createDataFrame([("r", x) for x in lines], "run string, line string"))
    assert sorted((r.stage_id, r.phase) for r in ss.stage_phases(ss.job_starts(events)).collect()) == [(7, "A"), (8, None)]
    out = ss.rollup_events(events)
    assert {r.phase: (r.job_span_s, r.partitions) for r in out.collect()} == {"A": (1.5, 3), None: (None, 5)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("= SparkListenerJobEnd)") == 1
