"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.functions.exprs import megabytes_per_second, seconds_between
from zoneflow.functions.formats import BLOCK_MARK, EXECUTOR_MARK
from zoneflow.operators import agg, compare, cv, features, heavy, ledger, matrix, runlog, runs, sampling, stagestats, timed
from zoneflow.plans import tables as t
from zoneflow.sources import files, logs, workdir
from zoneflow.sources.workdir import materialise, new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round for comparison: sums of doubles depend on the order of addition in the last digits."""
    return df.withColumns({c: F.round(c, digits) for c in names})


# ---- sources -------------------------------------------------------------------------------


@query
def scan_count(spark, sf):
    return spark.read.parquet(f"{sf}/lineitem*.parquet").agg(F.count(F.lit(1)).alias("rows_in"))


@query
def union_by_name(spark, sf):
    """Two stored halves of the trips with other widths, cases and columns, read as one table."""
    li = t.table(spark, sf, "lineitem")
    root = new_path(spark, "drift")
    old = li.filter("l_linenumber <= 3").select(
        F.col("l_suppkey").cast("int").alias("loc"), F.col("l_linenumber").alias("pc"), F.col("l_quantity").alias("Dist")
    )
    new = li.filter("l_linenumber > 3").select(
        F.col("l_suppkey").alias("LOC"), F.col("l_linenumber").cast("double").alias("pc"),
        F.col("l_quantity").alias("dist"), F.col("l_tax").alias("surcharge"),
    )
    old.write.parquet(f"{root}/year=1")
    new.write.parquet(f"{root}/year=2")
    out = files.read_union_by_name(spark, [f"{root}/year=1", f"{root}/year=2"])
    have = {c.lower(): c for c in out.columns}
    return out.select(*(F.col(have[c]).alias(c) for c in ("loc", "pc", "dist", "surcharge")))


@query
def csv_lookup(spark, sf):
    """Lookup written as CSV with one unused column, converted to Parquet, read back."""
    path = new_path(spark, "lookup")
    t.zones(spark, sf).withColumn("service_zone", F.lit("none")).write.option("header", True).csv(f"{path}/csv")
    return files.csv_to_parquet(spark, f"{path}/csv", f"{path}/parquet", ["LocationID", "Borough", "Zone"])


@query
def gen_zone_fare(spark, sf):
    return agg.zone_fare(t.table(spark, sf, "lineitem"), "l_orderkey")


@query
def file_inventory(spark, sf):
    return files.inventory_totals(files.file_inventory(spark, f"{sf}/*.parquet"), expected_files=14)


@query
def column_footprint(spark, sf):
    return files.column_footprint(files.footers(spark, f"{sf}/lineitem.parquet"), _NEEDED)


_NEEDED = ["l_shipdate", "l_suppkey", "l_quantity", "l_linenumber", "l_extendedprice", "l_tax"]


@query
def byte_totals(spark, sf):
    return files.byte_totals(files.footers(spark, f"{sf}/lineitem.parquet"), _NEEDED)


@query
def pruned_bytes(spark, sf):
    """Bytes that a read of two late months fetches from line items and orders when row groups outside of it are skipped."""
    needed = {"lineitem": "l_shipdate l_suppkey l_quantity l_linenumber l_extendedprice l_tax", "orders": "o_orderdate o_totalprice"}
    out = None
    for name, columns in needed.items():
        ranges = files.row_group_ranges(spark, f"{sf}/{name}.parquet", columns.split()[0], columns.split())
        one = files.surviving_bytes(ranges, "2001-09-01", "2001-11-01").select(F.lit(name).alias("name"), "*")
        out = one if out is None else out.unionAll(one)
    return out


@query
def scan_block(spark, sf):
    """What a scan run prints, as far as it does not depend on the clock, as a block and parsed back."""
    totals = files.byte_totals(files.footers(spark, f"{sf}/lineitem.parquet"), _NEEDED)
    profile = matrix.matrix_profile(t.trips(spark, sf), *t.WINDOW).select("rows_in", "rows_out")
    both = totals.unionByName(profile, allowMissingColumns=True)
    row = both.agg(*(F.max(c).alias(c) for c in both.columns))
    header = {"mode": F.lit("duckdb"), "platform": F.lit("local"), "stage": F.lit("1_duckdb"), "phase": F.lit("scan")}
    text = runlog.block_text(header, {c: F.col(c) for c in row.columns})
    blocks = runlog.parse_blocks(row.select(text.alias("text")), keep=[])
    kv = F.col("kv")
    return blocks.select(kv["mode"].alias("mode"), *(kv[c].cast("long").alias(c) for c in row.columns))


@query
def timed_scan(spark, sf):
    """The scan timed by itself: its block parsed, its counts, and whether its times and rate fit one another."""
    footer_rows = files.footers(spark, f"{sf}/lineitem.parquet")
    _, block = timed.timed_scan(t.trips(spark, sf), footer_rows, *t.WINDOW, needed=_NEEDED)
    kv = F.col("kv")
    num = lambda k: kv[k].cast("double")
    read = F.greatest(num("t_read_s"), F.lit(1e-3))
    rate = num("bytes_needed") / 1e6 / read / num("cores")
    return runlog.parse_blocks(block, keep=[]).select(
        *(kv[c].cast("long").alias(c) for c in ("bytes_on_disk", "bytes_needed", "rows_in", "rows_out")),
        ((num("t_read_s") > 0) & (num("t_write_s") >= 0) & (num("t_write_s") <= num("t_total_s"))).alias("times_fit"),
        # both sides are rounded
        (F.abs(num("mb_per_s_per_core") - rate) <= 0.06 + 0.02 * rate + rate * 0.006 / read).alias("rate_fits"),
    )


@query
def throughput(spark, sf):
    """Megabytes per second and core of every scan run's log."""
    kv = F.col("kv")
    num = lambda k: kv[k].cast("double")
    rate = megabytes_per_second(num("bytes_needed"), num("t_read_s"), 8)
    return _blocks(spark, sf).filter(kv["mode"] == "duckdb").select("path", rate.alias("mb_per_s_per_core"))


@query
def shipping_seconds(spark, sf):
    """Seconds between order and shipment of each line item."""
    o, li = t.table(spark, sf, "orders"), t.table(spark, sf, "lineitem")
    took = seconds_between(F.col("o_orderdate"), F.col("l_shipdate"))
    return li.join(o, li.l_orderkey == o.o_orderkey).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.sum(took).alias("seconds"), F.min(took).alias("least"), F.max(took).alias("most")
    )


# ---- model matrix --------------------------------------------------------------------------


@query
def model_matrix(spark, sf):
    return matrix.model_matrix(t.trips(spark, sf), *t.WINDOW)


@query
def stored_matrix(spark, sf):
    """The model matrix written once and read back, with what was stored beside what was meant."""
    meant = matrix.model_matrix(t.trips(spark, sf), *t.WINDOW)
    stored = materialise(meant)
    off = compare.differing_rows(meant, stored).agg(F.count(F.lit(1)).alias("off"))
    return stored.agg(F.count(F.lit(1)).alias("rows_out")).join(off).select(
        "rows_out", (F.col("off") == 0).alias("same_rows"), (F.col("off") == 0).alias("same_values")
    )


@query
def changed_rows(spark, sf):
    """One of two equal rows changed in a copy: what the comparison of the two tables names."""
    rows = t.table(spark, sf, "lineitem").select("l_linenumber", "l_returnflag", "l_linestatus", "l_tax")
    changed = F.when((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R"), F.lit(None)).otherwise(F.col("l_tax"))
    return compare.differing_rows(rows, rows.withColumn("l_tax", changed))


@query
def matrix_profile(spark, sf):
    out = matrix.matrix_profile(t.trips(spark, sf), *t.WINDOW)
    return rounded(out, 2, "sum_passengers", "sum_tip", "sum_fare", "sum_distance")


def _with_gaps(spark, sf) -> DataFrame:
    """Trips in which some values are missing, as null and as NaN."""
    gap = lambda c, missing, how: F.when(~missing, F.col(c)).otherwise(F.lit(how)).alias(c)
    return t.table(spark, sf, "lineitem").select(
        *t.ROW_KEYS,
        gap("l_extendedprice", F.col("l_discount") == 0.05, None),
        gap("l_quantity", F.col("l_tax") == 0.03, float("nan")),
        "l_tax",
    )


@query
def dropna_subset(spark, sf):
    return matrix.drop_incomplete(_with_gaps(spark, sf), ["l_extendedprice", "l_quantity"])


@query
def null_counts(spark, sf):
    return matrix.null_counts(_with_gaps(spark, sf), ["l_orderkey", "l_extendedprice", "l_quantity", "l_tax"])


# ---- zone features -------------------------------------------------------------------------


def _matrix(spark, sf, *extra: str) -> DataFrame:
    trips = t.trips(spark, sf, *extra)
    rows = trips.filter(matrix.in_window("tpep_pickup_datetime", *t.WINDOW) & matrix.valid_trip())
    return rows.select(*extra, *matrix.TAXI.projected)


def _joined(spark, sf) -> DataFrame:
    return features.lookup_join(_matrix(spark, sf), t.zones(spark, sf), "PULocationID", "LocationID")


@query
def zone_lookup_join(spark, sf):
    out = _joined(spark, sf).groupBy("Borough").agg(
        F.count(F.lit(1)).alias("n_trips"), F.sum("fare_amount").alias("sum_fare"), F.max("Zone").alias("last_zone")
    )
    return rounded(out, 2, "sum_fare")


@query
def lookup_unique(spark, sf):
    return features.key_uniqueness(t.zones(spark, sf), ["LocationID"])


@query
def key_skew(spark, sf):
    return rounded(features.key_skew(_matrix(spark, sf), "PULocationID"), 9, "max_share")


FEATURE_VALUES = ("mean_fare", "mean_tip_ratio", "p90_distance", "fare_per_km")


def _zone_features(spark, sf, **kw) -> DataFrame:
    out = features.zone_features(_joined(spark, sf), **kw)
    return rounded(out.withColumnRenamed("PULocationID", "zone"), 6, *FEATURE_VALUES)


@query
def zone_features(spark, sf):
    return _zone_features(spark, sf)


@query
def zone_features_skewed(spark, sf):
    """Many more ranges than zones, so that most zones' values lie in several tasks."""
    return _zone_features(spark, sf, tasks=64)


@query
def zone_features_grouped(spark, sf):
    out = features.zone_features_grouped(_joined(spark, sf))
    return rounded(out.withColumnRenamed("PULocationID", "zone"), 6, *FEATURE_VALUES)


@query
def longest_gaps(spark, sf):
    """Longest time without a pickup per zone, folded over the zone's trips in order, in many more tasks than zones."""
    return runs.longest_gaps(_matrix(spark, sf), ["PULocationID"], "tpep_pickup_datetime", tasks=64)


@query
def zone_features_approx(spark, sf):
    """Sketch percentiles: whether each value's rank is within the sketch's accuracy of the wanted one."""
    rows = _matrix(spark, sf)
    approximate = features.zone_features(rows, approximate=True)
    off = features.percentile_ranks(rows, approximate)
    # one row's share more than the accuracy, for the element at the edge
    fine = lambda c: (F.col(c) <= F.lit(1e-4) + 1 / F.col("n_trips")).alias(c.removesuffix("_off") + "_fine")
    return off.select(F.col("PULocationID").alias("zone"), "n_trips", fine("p90_distance_off"), fine("fare_per_km_off"))


# ---- one aggregation, several surfaces ------------------------------------------------------


def _zone_fare(spark, sf) -> DataFrame:
    return agg.zone_fare(t.table(spark, sf, "lineitem"), "l_orderkey")


def _method(name: str, method: str) -> None:
    QUERIES[name] = lambda spark, sf: rounded(agg.METHODS[method](_zone_fare(spark, sf)), 6, "avg_fare")


_method("agg_native", "builtin")
_method("agg_sql", "sql")
_method("agg_grouped_map", "frame")
_method("agg_two_level", "arrow_partials")
_method("agg_two_level_pandas", "pandas_partials")


@query
def five_way_agreement(spark, sf):
    rows = materialise(_zone_fare(spark, sf))
    return agg.agreement({name: method(rows) for name, method in agg.METHODS.items()})


@query
def agreement_totals(spark, sf):
    """The rows are cached once for all five methods and freed when the one result row is stored."""
    with workdir.cached(_zone_fare(spark, sf)) as rows:
        return materialise(agg.totals_check(agg.agreement({name: method(rows) for name, method in agg.METHODS.items()})))


@query
def distinct_keys(spark, sf):
    return agg.distinct_keys(_matrix(spark, sf), "PULocationID")


@query
def any_value_by(spark, sf):
    """The zone name depends on the zone, so any value of it is the value."""
    return agg.any_value_by(_joined(spark, sf), "PULocationID", "Zone")


# ---- samples, folds, grid ------------------------------------------------------------------


@query
def hash_sample(spark, sf):
    rows = t.trips(spark, sf, *t.ROW_KEYS)
    return sampling.sample_rows(rows, t.ROW_KEYS, fraction=0.4).select(*t.ROW_KEYS, "fare_amount")


@query
def target_sample(spark, sf):
    """Sample of about 20,000 rows, whatever the table's size."""
    rows = t.table(spark, sf, "lineitem")
    return sampling.sample_rows(rows, t.ROW_KEYS, target=20_000).select(*t.ROW_KEYS)


@query
def exact_sample(spark, sf):
    """Exactly 20,000 rows (or all), whatever the table's size."""
    return sampling.sample_exactly(t.table(spark, sf, "lineitem").select(*t.ROW_KEYS, "l_extendedprice"), [*t.ROW_KEYS, "l_extendedprice"], 20_000)


@query
def kfold_by_place(spark, sf):
    """Folds by place in the order of all keys; lines that share them are told apart by price."""
    order = [*t.ROW_KEYS, "l_extendedprice"]
    return sampling.with_folds_by_place(t.table(spark, sf, "lineitem").select(*order), order)


@query
def hot_keys(spark, sf):
    """Parts and customers in one key column with one key at three tenths: those with at least a hundredth of the rows, counted."""
    return heavy.heavy_keys(_skewed_lines(spark, sf), ["key"], share=0.01)


def _skewed_lines(spark, sf) -> DataFrame:
    key = F.when(F.col("l_orderkey") % 10 < 3, F.lit(0).cast("long")).otherwise(F.col("l_partkey"))
    return t.table(spark, sf, "lineitem").select(key.alias("key"), "l_orderkey", "l_linenumber")


@query
def split_hot_key(spark, sf):
    """Sixteen chunks of a table with one key at three tenths: all rows are there, and no chunk has twice the mean."""
    rows = materialise(heavy.repartition_split(_skewed_lines(spark, sf), "key", 16).withColumn("chunk", F.spark_partition_id()))
    # a key's rows in chunks of their own: keys below half a mean chunk are whole
    chunks = rows.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("key") == 0).alias("hot"))
    return chunks.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("hot") > 0).alias("hot_chunks"), (F.max("n") <= 2 * F.sum("n") / 16).alias("even"))


@query
def kfold_assign(spark, sf):
    return sampling.with_folds(t.table(spark, sf, "lineitem").select(*t.ROW_KEYS), t.ROW_KEYS)


def _features(spark, sf) -> DataFrame:
    """Zone features, stored and read back as the second phase reads them."""
    return materialise(features.zone_features(_joined(spark, sf)))


def _sample(spark, sf) -> DataFrame:
    slim = _matrix(spark, sf, *t.ROW_KEYS).select(
        *t.ROW_KEYS, "PULocationID", "trip_distance", "passenger_count", "fare_amount"
    )
    return sampling.join_features(slim, _features(spark, sf), "PULocationID")


@query
def sample_features(spark, sf):
    rows = sampling.sample_rows(_sample(spark, sf), t.ROW_KEYS, fraction=0.4)
    return rounded(rows.select(*t.ROW_KEYS, "PULocationID", *cv.FEATURES, "fare_amount"), 6, *FEATURE_VALUES)


def _design(spark, sf) -> DataFrame:
    rows = sampling.with_folds(_sample(spark, sf), t.ROW_KEYS)
    return cv.design_matrix(rows, keep=[*t.ROW_KEYS, "fold"])


@query
def design_matrix(spark, sf):
    return rounded(_design(spark, sf).drop("fold"), 6, *FEATURE_VALUES)


def _digits(stats: DataFrame) -> DataFrame:
    """Fold moments to about nine digits, counts as they are."""

    def digits(c: str) -> int:
        return 1 if c == "vyy" else 3 if c.endswith("y") else 5

    return stats.select(*(F.col(c) if c in ("fold", "n") else (F.round(c, digits(c)) + 0.0).alias(c) for c in stats.columns))


@query
def fold_statistics(spark, sf):
    return _digits(cv.fold_statistics(_design(spark, sf)))


@query
def kfold_train_stats(spark, sf):
    return _digits(cv.train_statistics(cv.fold_statistics(_design(spark, sf))))


@query
def pinned_partitions(spark, sf):
    """Rows per chunk when the number of chunks is pinned: all 16 exist, and every row is in one."""
    with workdir.pinned_partitions(spark, 16):
        # the shuffle of an ordinary grouping, which adaptive execution would merge into fewer chunks
        groups = _matrix(spark, sf).groupBy("PULocationID").agg(F.count(F.lit(1)).alias("n"))
        chunks = groups.groupBy(F.spark_partition_id().alias("chunk")).agg(F.sum("n").alias("n"))
        seen = materialise(chunks).agg(F.max("chunk")).first()[0]
        rows = materialise(features.repartition_by_key(_matrix(spark, sf), "PULocationID", 16).withColumn("chunk", F.spark_partition_id()))
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("PULocationID").alias("n_keys"),
        (F.count_distinct("chunk", "PULocationID") == F.count_distinct("PULocationID")).alias("whole_keys"),
        (F.lit(8 <= (seen or 0) < 16) & (F.count_distinct("chunk") > 4) & (F.max("chunk") < 16)).alias("pinned"),
    )


@query
def grid_parallelism(spark, sf):
    """Cells of the grid and how many of them run at once: no more than there are."""
    cores, n = spark.sparkContext.defaultParallelism, cv.COMBOS * cv.FOLDS
    few, many = (cv.effective_parallelism(spark, n) for n in (1, 10**9))
    # as many tasks as cells, and no more of them at once than there are cores
    spread = cv.grid(spark).withColumn("task", F.spark_partition_id()).join(_folds(spark, sf), "fold")
    return spread.agg(
        F.count(F.lit(1)).alias("cells"), F.lit(few).cast("int").alias("one_cell"),
        (F.lit(many == cores and cv.effective_parallelism(spark, n) == min(cores, n)) & (F.count_distinct("task") == F.count(F.lit(1)))).alias("some"),
    )


def _folds(spark, sf) -> DataFrame:
    return sampling.with_folds(t.table(spark, sf, "lineitem"), t.ROW_KEYS).select("fold").distinct()


@query
def grid_scores(spark, sf):
    return rounded(cv.grid_scores(_design(spark, sf)), 2, "score")


@query
def grid_map(spark, sf):
    """One feature and few rounds, where the damped fit is far from its limit."""
    rows = sampling.with_folds(_matrix(spark, sf, *t.ROW_KEYS), t.ROW_KEYS)
    design = cv.design_matrix(rows, ["trip_distance"], keep=["fold"])
    return rounded(cv.grid_scores(design, ["trip_distance"], combos=4, rounds=1), 2, "score")


@query
def timed_grid(spark, sf):
    """A grid run timed by itself, and its seconds per fit from its own block."""
    rows = sampling.with_folds(_matrix(spark, sf, *t.ROW_KEYS), t.ROW_KEYS)
    design = cv.design_matrix(rows, ["trip_distance"], keep=["fold"])
    scores, block = timed.timed_grid(design, ["trip_distance"], combos=4, rounds=1)
    blocks = materialise(runlog.parse_blocks(block, keep=[]))
    fits = F.col("kv")["fits_done"].cast("long")
    per_fit = ledger.seconds_per_fit(blocks, keep=["kv"])
    return per_fit.select(fits.alias("fits_done"), (F.col("seconds_per_fit") > 0).alias("timed")).join(
        scores.agg(F.count("score").alias("n_scores"))
    )


@query
def grid_task_map(spark, sf):
    """A user's function in one task per cell of the grid, with the cell's fold beside it: rows and mean of the other folds."""
    rows = sampling.with_folds(_matrix(spark, sf, *t.ROW_KEYS), t.ROW_KEYS)
    sums = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("trip_distance").alias("s"))
    side = materialise(sums.agg(F.sum("n").alias("n_all"), F.sum("s").alias("s_all")).join(sums))

    def score(cells):
        others = cells["n_all"] - cells["n"]
        mean = (cells["s_all"] - cells["s"]) / others
        return cells.assign(n_train=others, damped=mean * (1 - 0.5 ** cells["rounds"]))[["combo", "fold", "rounds", "n_train", "damped"]]

    cells = cv.grid(spark, combos=4, rounds=1)
    return rounded(cv.grid_map(cells, side, score, "combo int, fold int, rounds int, n_train long, damped double"), 6, "damped")


@query
def grid_scores_two(spark, sf):
    """Two features and few rounds: the solve itself shows in the score."""
    rows = sampling.with_folds(_matrix(spark, sf, *t.ROW_KEYS), t.ROW_KEYS)
    names = ["trip_distance", "passenger_count"]
    return rounded(cv.grid_scores(cv.design_matrix(rows, names, keep=["fold"]), names, combos=4, rounds=1), 2, "score")


@query
def grid_scores_factors(spark, sf):
    """The same two-feature scores, solved on triangular factors of the rows."""
    rows = sampling.with_folds(_matrix(spark, sf, *t.ROW_KEYS), t.ROW_KEYS)
    names = ["trip_distance", "passenger_count"]
    return rounded(cv.grid_scores_by_factors(cv.design_matrix(rows, names, keep=["fold"]), names, combos=4, rounds=1), 2, "score")


# ---- run logs ------------------------------------------------------------------------------


def _blocks(spark, sf) -> DataFrame:
    return runlog.parse_blocks(t.run_logs(spark, sf), keep=["path"])


@query
def format_blocks(spark, sf):
    header = {"mode": F.lit("rest"), "phase": F.col("l_returnflag")}
    body = {"wall_s": F.col("l_linenumber"), "zone": F.col("l_suppkey"), "status": F.col("l_linestatus")}
    return t.table(spark, sf, "lineitem").select(t.row_name().alias("path"), runlog.block_text(header, body).alias("text"))


@query
def parse_run_log(spark, sf):
    kv = F.col("kv")
    return _blocks(spark, sf).select(
        "path", "block", *(kv[k].alias(k) for k in ("listener_version", "mode", "phase", "wall_s", "rest_target", "note")),
        F.size("kv").alias("n_keys"),
    )


@query
def parse_log_files(spark, sf):
    """The same logs stored as text files, read back in sections and parsed: blocks per phase."""
    path = new_path(spark, "logs")
    # a compressed file is one task's work, so the logs lie in many
    stored = lambda texts: texts.write.mode("append").options(**_STORED_LOGS).text(path)
    stored(t.run_logs(spark, sf).select("text"))
    # logs that never printed a block or an end mark: whole documents
    stored(t.table(spark, sf, "documents").select(F.coalesce("text", F.lit("")).alias("text")))
    blocks = runlog.parse_blocks(logs.read_log_sections(spark, path), keep=["path", "start", "seq"])
    wall = F.col("kv")["wall_s"].cast("long")
    return blocks.groupBy(F.col("kv")["phase"].alias("phase"), F.col("kv")["mode"].alias("mode")).agg(
        F.count(F.lit(1)).alias("n_blocks"), F.sum(wall).alias("sum_wall_s")
    )


# Plain text of the logs is some fifteen times the tables it is made of.
_STORED_LOGS = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 50_000}


@query
def ledger_rows(spark, sf):
    name = F.concat(F.lit("r-"), F.substring_index("path", "/", 1))
    return runlog.ledger_rows(_blocks(spark, sf), name, F.lit(2), startup_s="60", keep=["path"])


@query
def ledger_lines(spark, sf):
    rows = runlog.ledger_rows(_blocks(spark, sf), "r-1", 4, keep=["path"])
    return runlog.ledger_lines(rows, keep=["path"])


@query
def ledger_csv(spark, sf):
    """Ledger stored as CSV and read back: rows and filled cells per stage and phase."""
    path = new_path(spark, "ledger")
    runlog.write_ledger(runlog.ledger_rows(_blocks(spark, sf), "r-1", 4), path)
    filled = lambda c: F.count(c).alias(f"n_{c}")
    return runlog.read_ledger(spark, path).groupBy("stage", "phase").agg(
        F.count(F.lit(1)).alias("n_rows"), filled("wall_s"), filled("shuffle_write_bytes"), filled("predicted_s")
    )


def _log_lines(spark, sf) -> DataFrame:
    return t.run_logs(spark, sf).select("path", F.explode(F.split("text", "\n")).alias("line"))


@query
def log_line_counts(spark, sf):
    markers = {"n_blocks": BLOCK_MARK, "n_executors": EXECUTOR_MARK}
    return runlog.line_counts(_log_lines(spark, sf), markers).drop("n_lines")


@query
def document_line_counts(spark, sf):
    """Whole texts, line by line: lines per source that hold a marker."""
    docs = t.table(spark, sf, "documents").select(F.col("source").alias("path"), F.explode(F.split("text", "\n")).alias("line"))
    return runlog.line_counts(docs, {"n_license": "License", "n_links": "http"})


@query
def lines_with_prefix(spark, sf):
    docs = t.table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return runlog.lines_with_prefix(docs, ["The", "Copyright", "Licensed"])


@query
def run_checks(spark, sf):
    executors = runlog.executor_counts(_log_lines(spark, sf))
    return runlog.run_checks(t.run_list(spark, sf), _blocks(spark, sf), executors)


# ---- stage statistics ----------------------------------------------------------------------


def _events(spark, sf) -> DataFrame:
    return materialise(logs.parse_events(t.event_lines(spark, sf)))


def _tasks(spark, sf) -> DataFrame:
    """The events' tasks, stored once; only the fields that tasks need are parsed."""
    return materialise(stagestats.event_tasks(logs.parse_events(t.event_lines(spark, sf), names=["SparkListenerTaskEnd"])))


@query
def stage_rollup(spark, sf):
    return stagestats.rollup_events(logs.parse_events(t.event_lines(spark, sf)))


@query
def event_ledger(spark, sf):
    """Event log to ledger: the rollup of every phase printed as a block, parsed, and made a ledger row."""
    rollup = stagestats.rollup_events(logs.parse_events(t.event_lines(spark, sf)))
    blocks = runlog.parse_blocks(stagestats.phase_blocks(rollup, "emr", "2_emr", 16), keep=["run"])
    return runlog.ledger_rows(blocks, "r-1", 4, keep=["run"])


def _applications(spark, sf) -> DataFrame:
    """Event lines of twenty applications, with the line that starts each."""
    lines = t.event_lines(spark, sf).select((F.col("run") % 20).alias("run"), "line")
    text = lambda c: F.concat(F.lit("app-"), c.cast("string"))
    pair = lambda *fields: F.to_json(F.struct(*fields)).alias("line")
    begun = lines.select("run").distinct().select(
        "run", pair(F.lit("SparkListenerApplicationStart").alias("Event"), text(F.col("run")).alias("App ID"), F.lit("1").alias("App Attempt ID"))
    )
    orders = t.table(spark, sf, "orders")
    added = orders.select(
        (F.col("o_custkey") % 20).alias("run"),
        pair(F.lit("SparkListenerExecutorAdded").alias("Event"), F.col("o_orderkey").cast("string").alias("Executor ID"),
             F.struct(F.col("o_orderpriority").alias("Host")).alias("Executor Info")),
    )
    return lines.unionAll(begun).unionAll(added)


def _rolled(spark, sf) -> DataFrame:
    """The applications' events from stored, rolled logs: a folder each, three numbered parts, the first two compacted into one."""
    path, place = new_path(spark, "events"), F.pmod(F.xxhash64("line"), F.lit(3)).cast("int") + 1
    name = lambda number, end="": F.concat(F.lit(f"events_{number}_app-"), F.col("run").cast("string"), F.lit(end))
    begins = F.col("line").contains("ApplicationStart")
    dealt = _applications(spark, sf).withColumn("part", F.when(begins, 1).otherwise(place))
    folder = F.concat(F.lit("eventlog_v2_app-"), F.col("run").cast("string")).alias("folder")
    # what is compacted is written once more if its part is still there
    both, compact, last = F.array(name(1), name(2, ".compact")), F.array(name(2, ".compact")), F.array(name(3))
    # lines without a run have no part to lie in, and only the compacted ones are kept
    known = F.col("run").isNotNull()
    files = F.explode(F.when(known & (F.col("part") == 1), both).when(F.col("part") <= 2, compact).when(known, last)).alias("file")
    # a compressed file is one task's work, so a long part lies in several
    pieces = -(-t.table(spark, sf, "lineitem").count() // _LINES_A_PIECE)
    piece = F.pmod(F.xxhash64(F.lit("piece"), "line"), F.lit(max(1, pieces)))
    out = dealt.select(folder, files, "line").repartition("folder", "file", piece)
    out.write.partitionBy("folder", "file").option("compression", "gzip").text(path)
    return logs.read_event_log(spark, path)


# Line items behind each piece of the applications' parts: at most some hundred thousand lines a file.
_LINES_A_PIECE = 3_000_000


@query
def rolled_event_logs(spark, sf):
    """The rollup of applications whose logs lie in several compressed parts, one of them told twice."""
    events = _rolled(spark, sf)
    return stagestats.rollup_events(events.withColumn("run", F.col("app_id")))


@query
def run_nodes(spark, sf):
    """Executors and hosts of every application, from its rolled log."""
    return stagestats.run_nodes(_rolled(spark, sf).withColumn("run", F.col("app_id")))


@query
def busy_times(spark, sf):
    """Time in which a phase's jobs ran, where jobs of one phase overlap and others run between them."""
    jobs = logs.parse_events(_applications(spark, sf), names=["SparkListenerJobStart", "SparkListenerJobEnd"])
    return stagestats.busy_times(stagestats.event_jobs(materialise(jobs)))


@query
def latest_attempts(spark, sf):
    events = _events(spark, sf)
    phases = stagestats.stage_phases(stagestats.event_jobs(events))
    attempts = stagestats.event_attempts(events).join(phases, stagestats.RUN_STAGE, "left")
    return stagestats.retried_stages(stagestats.latest_attempts(attempts))


@query
def task_quantiles(spark, sf):
    return stagestats.task_quantiles(_tasks(spark, sf))


@query
def task_quantiles_skewed(spark, sf):
    """More ranges than the session makes, so that stages' times lie in several tasks."""
    return stagestats.task_quantiles(_tasks(spark, sf), chunks=64)


@query
def not_seen_before(spark, sf):
    attempts = stagestats.event_attempts(_events(spark, sf))
    orders = t.table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    before = orders.select(F.col("o_custkey").alias("run"), F.col("o_orderkey").alias("stage_id"))
    return stagestats.not_seen_before(attempts, before).select("run", "stage_id", "attempt_id", "num_tasks", "status")


# ---- ledger --------------------------------------------------------------------------------


@query
def ledger_compare(spark, sf):
    keys = ["resource_id", *ledger.PREDICTION_KEYS]
    out = ledger.compare_nodes(ledger.with_predictions(t.ledger(spark, sf), t.predictions(spark, sf), keys))
    return rounded(out, 6, "predicted_small_s", "predicted_large_s", "wall_small_s", "wall_large_s", "speedup")


@query
def ledger_complete(spark, sf):
    return ledger.ledger_complete(t.ledger(spark, sf))


@query
def seconds_per_fit(spark, sf):
    return rounded(ledger.seconds_per_fit(_blocks(spark, sf)), 6, "seconds_per_fit")


@query
def ledger_cost(spark, sf):
    part = t.table(spark, sf, "part").filter("p_partkey % 10 <> 0")
    prices = part.select(F.col("p_partkey").alias("instance_type"), (F.col("p_retailprice") / 1000).alias("rate_usd"))
    out = ledger.with_cost(t.ledger(spark, sf), prices).groupBy("stage", "phase", "nodes").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("cost_usd").alias("n_priced"), F.sum("cost_usd").alias("cost_usd")
    )
    return rounded(out, 4, "cost_usd")
