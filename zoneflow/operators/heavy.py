"""Heavy hitters: the keys that hold many rows, found in one pass without counting every key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from zoneflow.sources.workdir import broadcast_if_small, materialise

# Counters of a task's summary: it misses at most one in this many of the task's rows.
COUNTERS = 4096


def key_summaries(df: DataFrame, keys: Sequence[str], counters: int = COUNTERS) -> DataFrame:
    """``keys, n, missed``: a frequent-items summary of every task, and one row with null ``n`` and the task's total error.

    A task counts its keys batch by batch. When it holds more than twice ``counters`` keys, the count of the
    largest one left out is taken off all, and those at zero go; whatever it was taken off, at most ``rows / counters`` in
    all, is the task's error. Summaries merge by adding counts and errors.
    """
    keys, rows = list(keys), df.select(*keys)
    arrow = to_arrow_schema(rows.schema)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        missed = total = 0
        for b in batches:
            counts = pa.Table.from_batches([b]).group_by(keys, use_threads=False).aggregate([([], "count_all")])
            for *key, n in zip(*(counts.column(c).to_pylist() for c in [*keys, "count_all"])):
                seen[tuple(key)] = seen.get(tuple(key), 0) + n
            total += b.num_rows
            if len(seen) > 2 * counters:
                cut = sorted(seen.values(), reverse=True)[counters]
                seen = {k: n - cut for k, n in seen.items() if n > cut}
                missed += cut
        out = [(*k, n, None) for k, n in seen.items()] + [(*[None] * len(keys), None, missed)]
        kinds = [arrow.field(k).type for k in keys] + [pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], [*keys, "n", "missed"])

    schema = T.StructType([*rows.schema.fields, T.StructField("n", T.LongType()), T.StructField("missed", T.LongType())])
    return rows.mapInArrow(summed, schema)


def heavy_keys(df: DataFrame, keys: Sequence[str], min_rows: int | None = None, share: float | None = None, counters: int = COUNTERS) -> DataFrame:
    """``keys, n``: exactly the keys with at least ``min_rows`` rows, or at least ``share`` of all rows. Null keys are left out.

    One pass makes a summary per task (at most ``2 * counters`` rows each). A key whose merged count plus the error of all
    tasks reaches the bound may be heavy; these, at most ``rows / bound`` and a few, are counted exactly in a second
    pass. Only if the bound is below the error, with very many rows, the first pass is done again with more counters.
    """
    keys = list(keys)
    rows = df.na.drop(subset=keys)
    while True:
        sums = materialise(key_summaries(rows, keys, counters).groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("missed").alias("missed")))
        total = rows.count() if share is not None else 0
        missed = sums.agg(F.sum("missed")).first()[0] or 0
        bound = max(1, min_rows if min_rows is not None else -int(-share * total // 1))
        if missed < bound:
            break
        counters *= 2 + 2 * missed // bound
    maybe = materialise(sums.filter(F.col("n") + missed >= bound).select(*keys))
    counted = rows.select(*keys).join(broadcast_if_small(maybe), keys, "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= bound)


def repartition_split(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` chunks by key; a key with more than half a mean chunk's rows is dealt over several neighbouring ones.

    Rule: a key with ``c`` of ``N`` rows gets ``min(n, ceil(2 * c * n / N))`` chunks, so what one key adds to a chunk
    is at most half the mean. The other keys lie whole in the chunk that their hash names.
    """
    total = max(1, df.count())
    hot = heavy_keys(df, [key], min_rows=max(1, total // (2 * n)))
    ways = materialise(hot.select(key, F.least(F.lit(n), F.ceil(2 * F.col("n") * n / total)).cast("int").alias("__ways")))
    marked = df.join(broadcast_if_small(ways), key, "left")
    turn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("__ways", F.lit(1))).cast("int")
    chunk = F.pmod(F.pmod(F.xxhash64(key), F.lit(n)).cast("int") + turn, F.lit(n))
    return marked.withColumn("__chunk", chunk).repartitionById(n, F.col("__chunk")).select(*df.columns)
