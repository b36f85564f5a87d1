"""Places of rows in an order, without a group or the whole table in one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.sources.workdir import materialise


def key_changes(columns: list[pa.Array], before: list[pa.Scalar] | None) -> np.ndarray:
    """True at each row whose key differs from that of the row before it (null equals null)."""
    n = len(columns[0])
    out = np.zeros(n, bool)
    for i, c in enumerate(columns):
        out[0] |= before is not None and not c[0].equals(before[i])
        differs = pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, n - 1)), False).to_numpy(zero_copy_only=False)
        holes = c.is_null().to_numpy(zero_copy_only=False)
        out[1:] |= differs.astype(bool) | (holes[1:] != holes[:-1])
    return out


def _carried(ends: list) -> list[tuple[int, int]]:
    """``(task, rows)``: how many rows of a task's first key lie in the tasks before it."""
    out, key, rows = [], None, 0
    for e in sorted(ends, key=lambda e: e["__part"]):
        carry = rows if key is not None and e["first_key"] == key else 0
        if carry:
            out.append((e["__part"], carry))
        key, rows = e["last_key"], e["last_rows"] + (carry if e["last_run"] == 0 else 0)
    return out


def with_places(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "place", weight: str | None = None, tasks: int | None = None
) -> DataFrame:
    """Add each row's place (from 0) among the rows with equal ``keys``, in the given order; no keys: in the whole table.

    Equal to ``row_number() - 1`` over a window, or with ``weight`` (a whole number per row) to the sum of the weights before
    the row. But a key's rows may lie in many tasks: the rows are range partitioned by keys and order, numbered within
    their task, and the result is stored. Only a task's first key can go on from the task before, so one row per
    task (its first and last key and how many rows these have) is all that the driver adds up. Null is a key like any
    other. Rows that are equal in keys and order take their places in no stated order. ``tasks``: ranges to make
    (default: the session's shuffle partitions).
    """
    spark, keys, columns = df.sparkSession, list(keys), df.columns
    by = [*(F.col(k) for k in keys), *(F.col(o) if isinstance(o, str) else o for o in order)]
    rows = (df.repartitionByRange(tasks, *by) if tasks else df.repartitionByRange(*by)).sortWithinPartitions(*by)
    heavy = None if weight is None else columns.index(weight)
    at = [columns.index(k) for k in keys]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, run, last = TaskContext.get().partitionId(), 0, 0, None
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            cells = [b.column(i) for i in at]
            new = key_changes(cells, last) if cells else np.zeros(n, bool)
            last = [c[n - 1] for c in cells]
            # a row's place counts from its run's begin, which may lie in an earlier batch
            w = np.ones(n, "i8") if heavy is None else b.column(heavy).to_numpy().astype("i8")
            before = np.cumsum(w) - w
            begin = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            place = np.where(begin < 0, before + done, before - before[np.maximum(begin, 0)])
            runs = run + np.cumsum(new)
            done, run = int(place[-1] + w[-1]), int(runs[-1])
            more = [pa.array(place, pa.int64()), pa.array(runs, pa.int64()), pa.array(np.full(n, part, "i4"))]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*b.schema.names, name, "__run", "__part"])

    schema = df.select("*", F.lit(0).cast("long").alias(name), F.lit(0).cast("long").alias("__run"), F.lit(0).alias("__part")).schema
    stored = materialise(rows.mapInArrow(numbered, schema))
    key = F.struct(*(F.col(k) for k in keys)) if keys else F.lit(0)
    ends = stored.groupBy("__part").agg(
        F.any_value(F.when(F.col("__run") == 0, key), True).alias("first_key"),
        F.max_by(key, "__run").alias("last_key"),
        F.max("__run").alias("last_run"),
        F.max_by(F.col(name) + (F.lit(1) if weight is None else F.col(weight)), F.struct("__run", name)).alias("last_rows"),
    )
    before = _carried(ends.collect())
    if not before:
        return stored.select(*columns, name)
    shift = F.broadcast(spark.createDataFrame(before, "__part int, __carried long"))
    goes_on = F.when(F.col("__run") == 0, F.coalesce("__carried", F.lit(0))).otherwise(F.lit(0))
    return stored.join(shift, "__part", "left").select(*columns, (F.col(name) + goes_on).alias(name))
