"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
import pickle
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.sources.workdir import materialise, new_path, work_root

__all__ = ["cell", "give_back", "latest_per_process", "map_batches", "materialise", "new_path", "per_process", "rows_and_bytes", "send", "text_or_empty", "work_root"]


def cell(name: str) -> Column:
    """Column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(name: str) -> Column:
    return F.coalesce(cell(name).cast("string"), F.lit(""))


def rows_and_bytes(docs: DataFrame, text: str) -> tuple[int, int]:
    """Rows and UTF-8 bytes of a text column, from one pass without a shuffle of rows."""
    row = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(text_or_empty(text)).cast("long"))).first()
    return row[0], row[1] or 0


def per_process(key, make: Callable):
    """What ``make()`` returned for ``key`` in this worker process; made at first use.

    Task functions arrive pickled by value, so module globals do not outlive a task; a module object
    in ``sys.modules`` does.
    """
    store = sys.modules.setdefault("_zoneflow_worker", types.ModuleType("_zoneflow_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def latest_per_process(name: str, key, make: Callable):
    """Like ``per_process``, but only the last ``key`` asked for under ``name`` is kept."""
    held = per_process(("latest", name), dict)
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]


def send(df: DataFrame, value) -> Callable:
    """Broadcast an object of one of our own classes; returns what gives it back, in a task or on the driver.

    A broadcast pickles classes by name, which only works where the package is installed, so it is sent as bytes that
    hold the class as well.
    """
    sent, key = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value)), uuid.uuid4().hex
    return lambda: latest_per_process("sent", key, lambda: pickle.loads(sent.value))


# Bytes of rows that Spark hands to Python at once; its own default is sixteen times that, held on both sides.
BATCH_BYTES, SPARK_BATCH_BYTES = 4 * 1024 * 1024, "67108864b"


def give_back() -> None:
    """Return freed memory to the machine: worker processes outlive tasks and would keep each one's peak."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library; nothing is lost but the memory until the process ends


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with batches of bounded bytes, and memory given back after each task.

    Sets the session's batch size where it is still the engine's default.
    """
    name, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    if conf.get(name) == SPARK_BATCH_BYTES:
        conf.set(name, f"{BATCH_BYTES}b")

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            give_back()

    return df.mapInArrow(mapped, schema)
