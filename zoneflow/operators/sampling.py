"""Samples and folds that depend on row keys only, not on partitioning or arrival order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.exprs import HASH_BITS, key_hash
from zoneflow.operators.places import with_places
from zoneflow.sources.workdir import broadcast_if_small

# Target rows and seed of the model sample.
SAMPLE_ROWS = 200_000
SAMPLE_SEED = 436


def sample_fraction(rows: int, target: int = SAMPLE_ROWS) -> float:
    """Fraction that gives about ``target`` rows; never above one, also for an empty table."""
    return min(1.0, target / max(rows, 1))


def sample_rows(
    df: DataFrame,
    keys: Sequence[str | Column],
    fraction: float | None = None,
    target: int = SAMPLE_ROWS,
    method: str = "hash",
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """Sample by a hash of row keys of any type, or ``method="bernoulli"`` for Spark's seeded draw.

    Without ``fraction`` the rows are counted once and about ``target`` of them are kept. The keys
    should identify a row: rows that share all of them are kept or dropped together. Null is a key like
    any other. A row that is kept at one fraction is kept at every larger one.
    """
    if fraction is None:
        fraction = sample_fraction(df.count(), target)
    if method == "bernoulli":
        return df.sample(fraction=fraction, seed=seed)
    return df.filter(key_hash(keys, f"sample{seed}") < int(min(1.0, fraction) * 2**HASH_BITS))


def fold_of(keys: Sequence[str | Column], folds: int) -> Column:
    """Fold label in [0, folds) from row keys, independent of the sample's hash."""
    return F.pmod(key_hash(keys, "fold"), F.lit(folds)).cast("int")


def with_folds(df: DataFrame, keys: Sequence[str | Column], folds: int = 5, name: str = "fold") -> DataFrame:
    return df.withColumn(name, fold_of(keys, folds))


def join_features(sample: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Inner join on the shared key; one feature row per key, broadcast when its size allows."""
    return sample.join(broadcast_if_small(features), on=key, how="inner")


# Bits of the key hash that one histogram tells apart; a second one tells apart the rows of a single step of the first.
_STEP_BITS = 16


def sample_exactly(df: DataFrame, keys: Sequence[str], n: int, seed: int = SAMPLE_SEED) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer): those with the least key hashes, ties by the keys themselves.

    Rows that share all keys are interchangeable, so of those at the cut some are kept. Two histograms of hash steps, combined
    in the tasks, find the step in which the ``n``-th row lies; only the rows of that step, a 2^32th of the table unless keys
    repeat, are put in order. Contains the sample of every smaller ``n``, up to equal keys.
    """
    if n <= 0:
        return df.limit(0)
    rows = df.withColumn("__h", key_hash(keys, f"sample{seed}"))
    step = lambda level: F.shiftright("__h", HASH_BITS - level * _STEP_BITS)
    taken, inside = 0, F.lit(True)
    for level in (1, 2):
        counts = rows.filter(inside).groupBy(step(level).alias("s")).agg(F.count(F.lit(1)).alias("n")).orderBy("s")
        cut = None
        for s, k in counts.collect():  # at most 2^16 rows
            if taken + k > n:
                cut = s
                break
            taken += k
        if cut is None:
            return df if level == 1 else rows.filter(step(1) <= first).select(*df.columns)
        if level == 1:
            first = cut
        inside = step(level) == cut
    whole = rows.filter(step(2) < cut)
    if taken == n:
        return whole.select(*df.columns)
    edge = with_places(rows.filter(inside), [], ["__h", *keys], "__place").filter(F.col("__place") < n - taken)
    return whole.select(*df.columns).unionAll(edge.select(*df.columns))


def with_folds_by_place(df: DataFrame, order: Sequence[str | Column], folds: int = 5, name: str = "fold") -> DataFrame:
    """Folds by the row's place in an order, modulo ``folds``: their sizes differ by one row at most.

    The places are counted over range partitions, so no task sees the whole table. Rows that are equal in the order
    take neighbouring places, in no stated order.
    """
    placed = with_places(df, [], order, "__place")
    return placed.select(*df.columns, F.pmod("__place", F.lit(folds)).cast("int").alias(name))
