"""The driver tables seen as trips, zones, runs and stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.functions.formats import EXECUTOR_MARK
from zoneflow.operators import runlog

WINDOW = ("1996-01-01", "2000-01-01")

# Together these identify a line item.
ROW_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """``lineitem`` under the taxi column names, plus any of its own columns."""
    return table(spark, sf_dir, "lineitem").select(
        *extra,
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        F.col("l_suppkey").cast("int").alias("PULocationID"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_linenumber").cast("double").alias("passenger_count"),
        F.col("l_extendedprice").alias("fare_amount"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("tip_amount"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``supplier`` with its nation as the zone lookup."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").cast("int").alias("LocationID"), F.col("n_name").alias("Borough"), F.col("s_name").alias("Zone")
    )


def row_name() -> Column:
    """Name of a line item's run. Two items may share all keys; their prices tell them apart."""
    parts = [*map(F.col, ROW_KEYS), F.floor("l_extendedprice")]
    return F.concat_ws("/", *(c.cast("string") for c in parts))


def run_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run log per line item: a scan run or a two-phase run, with the noise real logs have."""
    li = table(spark, sf_dir, "lineitem")
    whole = lambda c: F.floor(c).cast("long")
    price = whole(F.col("l_extendedprice"))
    odd = F.col("l_linenumber") % 2 == 1
    mode = F.when(F.col("l_returnflag") == "R", "degraded").otherwise("rest")
    scan = runlog.block_text(
        {"mode": F.lit("duckdb"), "platform": F.lit("ec2"), "stage": F.lit("1_duckdb"), "phase": F.lit("scan")},
        {
            "wall_s": whole(F.col("l_quantity")),
            "bytes_on_disk": price * 1000,
            "bytes_needed": price * whole(F.col("l_discount") * 100 + 0.5) * 125,
            "t_read_s": F.col("l_linenumber"),
        },
    )
    phase = lambda name, body: runlog.block_text(
        {"mode": F.lit("rest"), "platform": F.lit("emr"), "stage": F.lit("2_emr"), "phase": F.lit(name)}, body
    )
    first = phase(
        "A_aggregate",
        {
            "wall_s": F.lit(0),
            "shuffle_write_bytes": price,
            "partitions": F.when(F.col("l_linestatus") == "O", 16).otherwise(8),
            "retried": (F.col("l_returnflag") == "A").cast("int"),
            # a wrapped line, a key written twice, a value holding the separator
            "rest_target": F.concat(F.lit("advertised\nwrapped line\nwall_s="), whole(F.col("l_quantity")).cast("string")),
            "shuffle_partitions": F.lit(16),
            "note": F.concat(F.lit("a=b="), F.col("l_suppkey").cast("string")),
        },
    )
    second = phase(
        "B_fit",
        {
            "mode": mode,
            "wall_s": whole(F.col("l_quantity")) + 7,
            "partitions": F.lit(60),
            "retried": F.lit(0),
            "rest_target": F.lit("advertised"),
            "shuffle_partitions": F.lit(16),
            "fits_done": F.lit(60),
            "effective_parallelism": F.col("l_linenumber"),
        },
    )
    registered = F.repeat(F.lit(f"INFO {EXECUTOR_MARK} x=1\n"), F.col("l_linenumber"))
    printed = F.when(died(), "Traceback").when(odd, F.concat(first, F.lit("\nnoise=1\n"), second)).otherwise(scan)
    text = F.concat(F.lit("start\n"), registered, printed, F.lit("\n"))
    return li.select(*ROW_KEYS, row_name().alias("path"), text.alias("text"))


def died() -> Column:
    """Runs that stopped before they printed a block."""
    return F.floor(F.col("l_discount") * 100 + 0.5) == 10


def run_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per run: its log, the nodes it was given, and a pin for those that set their own."""
    even = F.col("l_suppkey") % 2 == 0
    return table(spark, sf_dir, "lineitem").select(
        row_name().alias("path"),
        F.when(even, F.col("l_linenumber")).otherwise(4).cast("long").alias("nodes"),
        F.when(F.col("l_suppkey") % 10 == 3, 8.0).alias("pin"),
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-log lines: an order is a stage run by a one-stage job, its line items are the tasks.

    The order's customer is the application and its priority the phase. Some jobs have no group, some jobs'
    lines are missing (a rolled log), some stages never ended, some have no tasks.
    """
    orders, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    started, ended = orders.filter("o_orderkey % 11 <> 0"), orders.filter("o_orderkey % 13 <> 0")
    phase = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority"))
    run, name = F.col("o_custkey"), lambda c, n: c.alias(n)
    start = F.col("o_orderkey") * 1000
    stage_id = name(F.col("o_orderkey"), "Stage ID")
    pair = lambda event, *fields: F.to_json(F.struct(name(F.lit(event), "Event"), *fields)).alias("line")
    job_start = started.select(
        run.alias("run"),
        pair(
            "SparkListenerJobStart",
            name(F.col("o_orderkey"), "Job ID"),
            name(start, "Submission Time"),
            name(F.array("o_orderkey"), "Stage IDs"),
            name(F.create_map(F.lit("spark.jobGroup.id"), phase), "Properties"),
        ),
    )
    job_end = started.select(
        run.alias("run"),
        pair(
            "SparkListenerJobEnd",
            name(F.col("o_orderkey"), "Job ID"),
            name(start + F.floor("o_totalprice").cast("long") * 100, "Completion Time"),
        ),
    )
    attempts = ended.withColumn(
        "attempt", F.explode(F.when(F.col("o_orderkey") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    )
    stage_end = attempts.select(
        run.alias("run"),
        pair(
            "SparkListenerStageCompleted",
            name(
                F.struct(
                    stage_id,
                    name(F.col("attempt"), "Stage Attempt ID"),
                    name((F.col("o_custkey") % 50 + 1), "Number of Tasks"),
                    name(F.when((F.col("o_orderstatus") == "F") & (F.col("attempt") == 0), "lost"), "Failure Reason"),
                ),
                "Stage Info",
            ),
        ),
    )
    ok = F.col("l_returnflag") != "R"
    read = F.when(F.col("l_discount") > 0.05, F.floor("l_extendedprice").cast("long")).otherwise(0)
    tasks = li.filter("l_orderkey % 17 <> 0").join(orders.select("o_orderkey", "o_custkey"), li.l_orderkey == F.col("o_orderkey")).select(
        run.alias("run"),
        pair(
            "SparkListenerTaskEnd",
            stage_id,
            name(F.col("l_linenumber") % 2, "Stage Attempt ID"),
            name(F.struct(name(F.when(ok, "Success").otherwise("ExceptionFailure"), "Reason")), "Task End Reason"),
            name(F.struct(name(~ok, "Failed")), "Task Info"),
            name(
                F.struct(
                    name((F.col("l_quantity") * 1000).cast("long"), "Executor Run Time"),
                    name(
                        F.struct(name(read, "Remote Bytes Read"), name(F.lit(0), "Local Bytes Read")),
                        "Shuffle Read Metrics",
                    ),
                    name(
                        F.struct(name(F.floor("l_extendedprice").cast("long"), "Shuffle Bytes Written")),
                        "Shuffle Write Metrics",
                    ),
                ),
                "Task Metrics",
            ),
        ),
    )
    return job_start.unionAll(job_end).unionAll(stage_end).unionAll(tasks)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history of ledgers: an order is a cluster, each of its line items one measured row."""
    li = table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    return li.select(
        F.when(n == 7, "1_duckdb").otherwise("2_emr").alias("stage"),
        F.col("l_orderkey").alias("resource_id"),
        F.when(n == 7, 1).when(n % 2 == 0, 2).otherwise(4).cast("int").alias("nodes"),
        F.when(n == 7, "scan").when(n <= 3, "A_aggregate").otherwise("B_fit").alias("phase"),
        F.col("l_quantity").alias("wall_s"),
        (F.col("l_discount") * 100).alias("startup_s"),
        F.col("l_partkey").alias("instance_type"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction per cluster (order), phase and node count; some clusters have none."""
    cells = F.array(
        *(
            F.struct(F.lit(s).alias("stage"), F.lit(p).alias("phase"), F.lit(n).alias("nodes"))
            for s, p, n in (
                ("1_duckdb", "scan", 1),
                ("2_emr", "A_aggregate", 2),
                ("2_emr", "A_aggregate", 4),
                ("2_emr", "B_fit", 2),
                ("2_emr", "B_fit", 4),
            )
        )
    )
    o = table(spark, sf_dir, "orders").filter("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("resource_id"), "o_totalprice", F.explode(cells).alias("c"))
    return o.select("resource_id", "c.*", (F.col("o_totalprice") / F.col("c.nodes")).alias("predicted_s"))
