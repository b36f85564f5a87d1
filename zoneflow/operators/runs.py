"""A user's function over whole groups in order, when a group may be a third of the table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from zoneflow.operators.places import key_changes
from zoneflow.sources.workdir import materialise

Step = Callable[[Any, pd.DataFrame], Any]


def _runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, pd.DataFrame, bool]]:
    """``(key, rows, new)``: consecutive rows of one key, batch by batch; ``new`` where the key has changed."""
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cells = b.columns[:n_keys]
        new = key_changes(cells, last)
        cuts = [0, *(i for i in np.flatnonzero(new).tolist() if i), b.num_rows]
        frame = b.to_pandas()
        for lo, hi in zip(cuts, cuts[1:]):
            yield tuple(c[lo].as_py() for c in cells), frame.iloc[lo:hi, n_keys:], last is None or bool(new[lo])
            last = [c[hi - 1] for c in cells]


def fold_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], start: Callable[[], Any], step: Step, merge: Callable[[Any, Any], Any],
    finish: Callable[[Any], tuple], schema: str, tasks: int | None = None,
) -> DataFrame:
    """``keys`` and ``finish(state)`` per group, where the state is folded over the group's rows in order.

    ``state = step(state, frame)`` takes the next rows of the group, a batch at most, beginning with ``start()``;
    ``merge(a, b)`` joins the state of a run of rows with that of the run after it. Rows are range partitioned by
    keys and order, so a hot group is several runs in several tasks, each folded on its own; the states of a group's
    runs, one row per task at most, are then merged in order. So ``step`` sees every row once and in order,
    and neither a group nor its rows are ever in one place. The state should be small, and
    ``merge(step(start(), x), step(start(), y))`` must equal ``step(step(start(), x), y)``. Null keys are dropped.
    """
    keys = list(keys)
    df = df.na.drop(subset=keys)
    by = [*(F.col(k) for k in keys), *(F.col(o) if isinstance(o, str) else o for o in order)]
    rows = (df.repartitionByRange(tasks, *by) if tasks else df.repartitionByRange(*by)).sortWithinPartitions(*by)
    rows = rows.select(*keys, *(c for c in df.columns if c not in keys))
    fields = [df.schema[k] for k in keys]
    names, dump = [*keys, "__part", "__state"], cloudpickle.dumps

    def batch(out: list[tuple], kinds: list[pa.DataType], titles: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], titles)

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, key, state, out, kinds = TaskContext.get().partitionId(), None, None, [], None

        def peek() -> Iterator[pa.RecordBatch]:
            nonlocal kinds
            for b in batches:
                kinds = [*(c.type for c in b.columns[: len(keys)]), pa.int32(), pa.binary()]
                yield b

        for k, frame, new in _runs(peek(), len(keys)):
            if new:
                if key is not None:
                    out.append((*key, part, dump(state)))
                key, state = k, start()
                if len(out) >= 1000:
                    yield batch(out, kinds, names)
                    out = []
            state = step(state, frame)
        if key is not None:
            yield batch([*out, (*key, part, dump(state))], kinds, names)

    states = materialise(rows.mapInArrow(folded, T.StructType([*fields, T.StructField("__part", T.IntegerType()), T.StructField("__state", T.BinaryType())])))
    result = T.StructType([*fields, *T.StructType.fromDDL(schema).fields])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []
        load = cloudpickle.loads
        for b in batches:
            for *k, _, raw in zip(*(c.to_pylist() for c in b.columns)):
                if tuple(k) != key:
                    if key is not None:
                        out.append((*key, *finish(state)))
                    key, state = tuple(k), load(raw)
                else:
                    state = merge(state, load(raw))
            if out:
                yield _frame(out, result)
                out = []
        if key is not None:
            yield _frame([(*key, *finish(state))], result)

    return states.repartition(*keys).sortWithinPartitions(*keys, "__part").mapInArrow(merged, result)


def _frame(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema.names)


def longest_gaps(df: DataFrame, keys: Sequence[str], at: str, tasks: int | None = None) -> DataFrame:
    """``keys, n, longest_gap``: the longest time between neighbouring values of a number or time column per group.

    Not a sum of parts: the gap between the last row of one chunk and the first of the next counts as well. Null values are
    left out; a group with one value has no gap (null). Times are taken in seconds.
    """
    kind = df.schema[at].dataType
    value = F.unix_micros(F.col(at).cast("timestamp")) / F.lit(1e6) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else F.col(at).cast("double")
    rows = df.select(*keys, value.alias("__at")).filter("__at IS NOT NULL")

    def step(state, frame: pd.DataFrame):
        v = frame["__at"].to_numpy()
        inner = np.diff(v, prepend=v[0] if state is None else state[2])
        best = inner[1:] if state is None else inner
        gap = float(best.max()) if len(best) else -1.0
        return (len(v), v[0], v[-1], gap) if state is None else (state[0] + len(v), state[1], v[-1], max(state[3], gap))

    merge = lambda a, b: (a[0] + b[0], a[1], b[2], max(a[3], b[3], float(b[1] - a[2])))
    finish = lambda s: (s[0], None if s[3] < 0 else s[3])
    return fold_groups(rows, keys, ["__at"], lambda: None, step, merge, finish, "n long, longest_gap double", tasks)
