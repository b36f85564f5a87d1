"""One grouped count-and-mean over several execution surfaces, and their comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.sources.workdir import broadcast_if_small, materialise

# The generated table's zone count, multiplier, modulus and divisor.
ZONES = 265
FARE_STEP = 7919
FARE_CYCLE = 10_000
FARE_SCALE = 100.0

# Rows of one key that a pandas function may receive as one frame.
MAX_FRAME_ROWS = 1_000_000

# Rows summed at once inside a partition.
PARTIAL_ROWS = 1_000_000


def zone_fare(ids: DataFrame, id_column: str = "id") -> DataFrame:
    """``zone int, fare double`` computed from an id column."""
    i = F.col(id_column)
    return ids.select(
        (i % ZONES).cast("int").alias("zone"),
        ((i * FARE_STEP) % FARE_CYCLE / FARE_SCALE).alias("fare"),
    )


def generate_zone_fare(spark: SparkSession, rows: int, partitions: int) -> DataFrame:
    """The generated table itself, ``rows`` ids over ``partitions`` chunks."""
    return zone_fare(spark.range(0, rows, 1, partitions))


def by_builtin(df: DataFrame) -> DataFrame:
    """Plain grouped aggregate: partial sums below the shuffle."""
    return df.groupBy("zone").agg(F.count(F.lit(1)).alias("n"), F.avg("fare").alias("avg_fare"))


def by_sql(df: DataFrame) -> DataFrame:
    """The same plan from SQL text."""
    return df.sparkSession.sql(
        "SELECT zone, count(*) AS n, avg(fare) AS avg_fare FROM {df} GROUP BY zone", df=df
    )


def _combine(partials: DataFrame) -> DataFrame:
    return partials.groupBy("zone").agg(
        F.sum("n").alias("n"), (F.try_divide(F.sum("s"), F.sum("m"))).alias("avg_fare")
    )


def grouped_map(
    df: DataFrame, keys: Sequence[str], fn: Callable[[tuple, pd.DataFrame], pd.DataFrame], schema: str, max_frame: int = MAX_FRAME_ROWS
) -> DataFrame:
    """Hand ``fn(key, frame)`` frames of at most about ``max_frame`` rows of one key.

    A small group arrives as one frame. A larger one arrives in several, so ``fn`` must return what can be
    combined; only the keys that need it are cut, each into as many slices as its own size asks for. A slice is
    drawn by a hash of the row's place, so input that is already grouped by key is cut as well. Null keys are dropped.
    """
    keys = list(keys)
    df = df.na.drop(subset=keys)
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > max_frame)
    large = large.select(*keys, F.ceil(F.col("__n") / max_frame).alias("__slices"))
    if not large.take(1):
        return df.groupBy(*keys).applyInPandas(fn, schema)
    place = F.xxhash64(F.monotonically_increasing_id())
    cut = df.withColumn("__place", place).join(broadcast_if_small(materialise(large)), keys, "left")
    slice_ = F.coalesce(F.pmod("__place", "__slices"), F.lit(0).cast("long"))
    rows = cut.select(*df.columns, slice_.alias("__slice"))

    def each(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return fn(key[: len(keys)], frame.drop(columns="__slice"))

    return rows.groupBy(*keys, "__slice").applyInPandas(each, schema)


def by_frame(df: DataFrame, max_frame: int = MAX_FRAME_ROWS) -> DataFrame:
    """Grouped map: a pandas function per zone, whose sums are combined."""

    def sums(zone: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        known = frame["fare"].dropna()
        return pd.DataFrame([(zone[0], len(frame), len(known), known.sum())], columns=["zone", "n", "m", "s"])

    return _combine(grouped_map(df, ["zone"], sums, "zone int, n long, m long, s double", max_frame))


def _gather(batches: Iterator, rows: int = PARTIAL_ROWS) -> Iterator[list]:
    """Lists of consecutive batches of about ``rows`` rows: fewer, larger partial sums, bounded memory."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= rows:
            yield held
            held, n = [], 0
    if held:
        yield held


def by_arrow_partials(df: DataFrame) -> DataFrame:
    """Two levels: Arrow sums inside each partition, then a small shuffle."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _gather(batches):
            # one thread: a task already holds one core
            groups = pa.Table.from_batches(held).group_by("zone", use_threads=False)
            sums = groups.aggregate([([], "count_all"), ("fare", "count"), ("fare", "sum")])
            out = sums.select(["zone", "count_all", "fare_count", "fare_sum"]).rename_columns(["zone", "n", "m", "s"])
            yield from out.to_batches()

    return _combine(df.select("zone", "fare").mapInArrow(partial, "zone int, n long, m long, s double"))


def by_pandas_partials(df: DataFrame) -> DataFrame:
    """The same two levels with pandas frames."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for held in _gather(batches):
            g = pd.concat(held, ignore_index=True).groupby("zone", dropna=False, sort=False)["fare"]
            yield pd.DataFrame({"n": g.size(), "m": g.count(), "s": g.sum()}).reset_index()

    return _combine(df.select("zone", "fare").mapInPandas(partial, "zone int, n long, m long, s double"))


METHODS = {
    "builtin": by_builtin,
    "sql": by_sql,
    "frame": by_frame,
    "arrow_partials": by_arrow_partials,
    "pandas_partials": by_pandas_partials,
}


def agreement(results: dict[str, DataFrame], tolerance: float = 1e-6) -> DataFrame:
    """Per zone: how many methods reported it, the agreed count, and whether all agree."""
    labelled = None
    for r in results.values():
        r = r.select("zone", "n", "avg_fare")
        labelled = r if labelled is None else labelled.unionByName(r)
    spread = F.coalesce(F.max("avg_fare") - F.min("avg_fare"), F.lit(0.0))
    per_zone = labelled.groupBy("zone").agg(
        F.count(F.lit(1)).alias("n_methods"),
        F.max("n").alias("n"),
        ((F.count(F.lit(1)) == len(results)) & (F.min("n") == F.max("n")) & (spread <= tolerance)).alias("agree"),
    )
    return per_zone


def totals_check(per_zone: DataFrame) -> DataFrame:
    """One row: zones, rows, and whether every zone agreed."""
    return per_zone.agg(
        F.count(F.lit(1)).alias("n_zones"), F.sum("n").alias("n_rows"), F.every("agree").alias("all_agree")
    )


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct values of a column in order."""
    return df.select(key).distinct().orderBy(key)


def any_value_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Row count and some value of ``value`` per key."""
    return df.groupBy(key).agg(F.any_value(value).alias(value), F.count(F.lit(1)).alias("n"))
