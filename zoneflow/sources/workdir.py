"""Shared work folder: where intermediate tables go so that lost executors cost nothing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A build side above this many payload bytes is not sent to every executor.
MAX_BROADCAST_BYTES = 32 * 1024 * 1024


@cache
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="zoneflow-")


def work_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_root(spark.sparkContext.applicationId)
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str | None = None, compression: str | None = None) -> DataFrame:
    """Write a result and read it back, so later steps read files and not the lineage.

    The table that comes back also carries its real size, which lets the planner decide on
    a broadcast from a fact and not from an estimate. ``compression``: other than the session's.
    """
    spark = df.sparkSession
    path = path or new_path(spark, "table")
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def payload_bytes(df: DataFrame) -> int:
    """Bytes of the values of ``df``: 8 per fixed-width cell, real length for the rest."""
    width = F.lit(0).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            cell = F.octet_length(c)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cell = F.octet_length(F.to_json(F.struct(c)))
        else:
            cell = F.lit(8)
        width = width + F.coalesce(cell, F.lit(0)).cast("long") + 8
    return df.agg(F.sum(width)).first()[0] or 0


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring; otherwise leave the join to AQE (with skew splits)."""
    return F.broadcast(df) if payload_bytes(df) <= max_bytes else df


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set session options for one block of work and put the old values back."""
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def pinned_partitions(spark: SparkSession, n: int) -> Iterator[None]:
    """Keep exactly ``n`` chunks after a shuffle: fixed count, no adaptive merging.

    For runs whose chunk count has to be compared; normal work leaves merging on.
    """
    with session_conf(
        spark,
        {
            "spark.sql.shuffle.partitions": str(n),
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    ):
        yield


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Compute ``df`` once, reuse it inside the block, free it after."""
    df.persist()
    df.count()
    try:
        yield df
    finally:
        df.unpersist()
