"""Exact grouped quantiles that hold when one group has a large share of all rows.

Values are counted per group first, which combines in the tasks. The distinct ones are dealt by ranges of (group, value), so a
hot group splits by value, and running sums of the counts tell which ranks each value has. The wanted ranks pick
their values. That is two shuffles of rows whatever the groups' sizes; no group is in one task and nothing is
repeated until it fits. Where the groups' sizes, which are known from the aggregates, show that no group is large, the
built-in exact aggregates do the same in one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.operators.places import with_places
from zoneflow.sources.workdir import materialise


# Groups up to this many rows are bounded work for one task (some tens of MB of values).
MAX_GROUP_ROWS = 500_000


@dataclass(frozen=True)
class Quantile:
    """One quantile of ``column`` per group.

    ``linear`` interpolates between neighbours, ``index`` takes the sorted element at
    ``min(floor(fraction * n), n - 1)``. ``strict`` makes the result null when any row of the
    group misses the value; otherwise missing values are skipped.
    """

    name: str
    column: str
    fraction: float
    strict: bool = False
    method: str = "linear"

    def native(self) -> Column:
        """By the built-in aggregates, which gather a group's values in one task."""
        c = F.col(self.column)
        if self.method == "index":
            at = F.least(F.floor(F.count(c) * F.lit(self.fraction)), F.count(c) - 1)
            value = F.get(F.sort_array(F.collect_list(c)), at.cast("int"))
        else:
            value = F.percentile(c, F.lit(self.fraction))
        return (F.when(F.count(F.lit(1)) == F.count(c), value) if self.strict else value).alias(self.name)

    def approximate(self, accuracy: int = 10_000) -> Column:
        value = F.percentile_approx(self.column, self.fraction, accuracy).cast("double")
        return (F.when(F.count(F.lit(1)) == F.count(self.column), value) if self.strict else value).alias(self.name)

    def ranks(self, rows: Column, n: Column) -> tuple[Column, Column, Column]:
        """Lower and upper rank of the quantile among ``n`` values of ``rows`` rows, and the upper one's weight."""
        wanted = (n > 0) & ((n == rows) if self.strict else F.lit(True))
        if self.method == "index":
            at = F.least(F.floor(F.lit(self.fraction) * n), n - 1).cast("double")
        else:
            at = F.lit(self.fraction) * (n - 1)
        rank = lambda r: F.when(wanted, r.cast("long"))
        return rank(F.floor(at)), rank(F.ceil(at)), at - F.floor(at)


def summarise(
    df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], quantiles: Sequence[Quantile], tasks: int | None = None
) -> DataFrame:
    """``groupBy(keys)`` with ordinary aggregates and exact quantiles of double columns. Null keys are dropped.

    The source is read twice: for the aggregates and for the values. ``tasks``: deal values to so many ranges whatever
    the groups' sizes (default: only for groups above ``MAX_GROUP_ROWS``, to the session's shuffle partitions).
    """
    keys, columns = list(keys), sorted({q.column for q in quantiles})
    df = df.na.drop(subset=keys)
    if not quantiles:
        return df.groupBy(*keys).agg(*aggs)
    sizes = [F.count(F.lit(1)).alias("__rows"), *(F.count(c).alias(f"__n_{c}") for c in columns)]
    groups = materialise(df.groupBy(*keys).agg(*aggs, *sizes))
    named = [c for c in groups.columns if c not in ("__rows", *(f"__n_{c}" for c in columns))]
    if tasks is None and (groups.agg(F.max("__rows")).first()[0] or 0) <= MAX_GROUP_ROWS:
        return groups.select(*named).join(df.groupBy(*keys).agg(*(q.native() for q in quantiles)), keys)
    value = [F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)]
    each = df.select(*keys, F.explode(F.array(*value)).alias("__x")).select(*keys, "__x.c", "__x.v").filter("v IS NOT NULL")
    counted = each.groupBy(*keys, "c", "v").agg(F.count(F.lit(1)).alias("__k"))
    placed = with_places(counted, [*keys, "c"], ["v"], "__before", weight="__k", tasks=tasks)
    ranked = placed.join(groups.select(*keys, "__rows", *(f"__n_{c}" for c in columns)), keys)
    picks, hits = [], []
    for j, q in enumerate(quantiles):
        low, high, _ = q.ranks(F.col("__rows"), F.col(f"__n_{q.column}"))
        for side, r in (("low", low), ("high", high)):
            hit = (F.col("c") == columns.index(q.column)) & (r >= F.col("__before")) & (r < F.col("__before") + F.col("__k"))
            hits.append(hit)
            picks.append(F.max(F.when(hit, F.col("v"))).alias(f"__{side}{j}"))
    picked = ranked.filter(reduce(lambda a, b: a | b, hits)).groupBy(*keys).agg(*picks)
    out = groups.join(picked, keys, "left")

    def result(j: int, q: Quantile) -> Column:
        low, high, share = F.col(f"__low{j}"), F.col(f"__high{j}"), q.ranks(F.col("__rows"), F.col(f"__n_{q.column}"))[2]
        return F.when(share == 0, low).otherwise((1 - share) * low + share * high).alias(q.name)

    return out.select(*named, *(result(j, q) for j, q in enumerate(quantiles)))
