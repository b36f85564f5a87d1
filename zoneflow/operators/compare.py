"""Comparing two large results as multisets of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a row; which values are null is part of it."""
    cells = [c for n in columns for c in (F.isnull(n), F.col(n))]
    return F.xxhash64(F.lit(1), *cells), F.xxhash64(F.lit(2), *cells)


def row_digests(df: DataFrame, columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n, low, high, other``: per hash bucket the rows and sums of their hashes, whatever their order.

    Sums count equal rows as often as they occur, which an exclusive or would cancel. They are added up in halves, so
    they do not overflow, and are combined in the tasks: a bucket is one row per task.
    """
    a, b = _hashes(columns)
    rows = df.select(a.alias("a"), b.alias("b"))
    half = lambda c, shift: F.shiftrightunsigned(F.col(c), shift).bitwiseAND((1 << 32) - 1)
    return rows.groupBy(F.pmod("a", F.lit(buckets)).cast("int").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(half("a", 0)).alias("low"), F.sum(half("a", 32)).alias("high"), F.sum(half("b", 0)).alias("other")
    )


def differing_rows(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows, by all columns of ``left``, that the two results hold in different numbers: ``n_left``, ``n_right``.

    Both are read once for digests of their hash buckets; only rows of buckets whose digests differ are read again and
    shuffled. Null equals null. Column order of ``right`` does not matter; other columns of it are left out.
    """
    columns = left.columns
    right = right.select(*columns)
    a, b = row_digests(left, columns, buckets).alias("l"), row_digests(right, columns, buckets).alias("r")
    same = F.lit(True)
    for c in ("n", "low", "high", "other"):
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    unequal = a.join(b, F.col("l.bucket") == F.col("r.bucket"), "full").filter(~same).select(F.coalesce("l.bucket", "r.bucket").alias("__bucket"))
    unequal = F.broadcast(unequal)  # at most ``buckets`` numbers
    place = F.pmod(_hashes(columns)[0], F.lit(buckets)).cast("int")
    pick = lambda d, side: d.withColumn("__bucket", place).join(unequal, "__bucket", "left_semi").select(*columns, F.lit(side).alias("__side"))
    both = pick(left, 0).unionAll(pick(right, 1))
    counts = both.groupBy(*columns).agg(F.count_if(F.col("__side") == 0).alias("n_left"), F.count_if(F.col("__side") == 1).alias("n_right"))
    return counts.filter("n_left <> n_right")
