"""Column expressions with the null, rounding and text rules the operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.formats import WHITESPACE


def nan_to_null(c: Column) -> Column:
    """Missing is missing, whether the file stored it as null or as NaN."""
    return F.when(~F.isnan(c), c)


def at_least(c: Column, floor: float) -> Column:
    """Clip from below, keeping null null (a bare ``greatest`` would return the floor)."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(floor)))


def at_most(c: Column, ceiling: Column | float) -> Column:
    return F.when(c.isNotNull(), F.least(c, ceiling if isinstance(ceiling, Column) else F.lit(ceiling)))


def ratio(num: Column, den: Column, floor: float) -> Column:
    """Division by a denominator that is kept at or above ``floor`` (> 0)."""
    return num / at_least(den, floor)


def avg_if_complete(c: Column) -> Column:
    """Mean of the group, or null when any row of the group misses the value."""
    return F.when(F.count(F.lit(1)) == F.count(c), F.avg(c))


def megabytes_per_second(n_bytes: Column, seconds: Column, cores: Column | int = 1) -> Column:
    """Decimal megabytes per second and core, one decimal; time is kept above zero."""
    cores = cores if isinstance(cores, Column) else F.lit(cores)
    return F.round(n_bytes / F.lit(1e6) / at_least(seconds, 1e-9) / cores, 1)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole and fractional seconds between two timestamps of either kind."""

    def micros(c: Column) -> Column:
        return F.unix_micros(c.cast("timestamp"))

    return (micros(end) - micros(start)) / F.lit(1e6)


def key_value(line: Column) -> Column:
    """``struct(k, v)`` of a line cut at its first ``=``."""
    k = F.substring_index(line, "=", 1)
    return F.struct(k.alias("k"), F.substr(line, F.length(k) + 2).alias("v"))


def strip(c: Column) -> Column:
    """Without leading and trailing whitespace of any kind."""
    return F.trim(c, F.lit(WHITESPACE))


def split_any(c: Column, separators: str) -> Column:
    """Pieces between any of the separator characters, empty ones included."""
    return F.split(F.translate(c, separators, "\n" * len(separators)), "\n")


def last_wins_map(df: DataFrame, pairs: str, name: str) -> DataFrame:
    """Replace an array column of (k, v) structs by a map in which a later pair overrides an earlier.

    In steps, so that the lambda reads columns and does not recompute the array per key. The map
    leaves through a one-element ``explode`` because a filter on it would otherwise be pushed below
    these steps and undo that.
    """
    others = [c for c in df.columns if c != pairs]
    back = df.withColumn(pairs, F.reverse(pairs)).withColumn("__keys", F.transform(pairs, lambda p: p["k"]))
    distinct = F.array_distinct("__keys")
    latest = F.transform(
        distinct,
        lambda k: F.struct(
            k.alias("k"), F.get(F.col(pairs), F.array_position("__keys", k).cast("int") - 1)["v"].alias("v")
        ),
    )
    entries = F.when(F.size(distinct) == F.size("__keys"), F.col(pairs)).otherwise(latest)
    return back.select(*others, F.explode(F.array(F.map_from_entries(entries))).alias(name))


# Hash values lie in [0, 2**HASH_BITS): the leading hexadecimal digits of an MD5, which every SQL engine has.
HASH_BITS = 60


def key_hash(columns: Sequence[str | Column], seed: str) -> Column:
    """Well mixed 60-bit integer of a row's key columns, of any type, null included.

    It depends on the values and the seed only; values of different seeds are independent. Each part is told with its
    length and null has none, so no two different keys are one text.
    """
    parts = [F.lit(seed)]
    for c in columns:
        c = F.col(c) if isinstance(c, str) else c
        text = c.cast("string")
        parts += [F.lit("/"), F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))]
    digits = F.substring(F.md5(F.concat(*parts)), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")
