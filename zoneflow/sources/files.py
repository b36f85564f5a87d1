"""File inventory, Parquet footers, drifting schemas, CSV."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.sources.workdir import materialise

# Footers opened by one task; a footer is a few kilobytes and one round trip.
FILES_PER_TASK = 256
MAX_FOOTER_TASKS = 4096


def file_inventory(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per file: ``path, length``. File contents are not read."""
    return spark.read.format("binaryFile").load(paths).select("path", "length")


def inventory_totals(files: DataFrame, expected_files: int | None = None) -> DataFrame:
    """Object count and total bytes, with a check against the expected count."""
    out = files.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"))
    if expected_files is None:
        return out
    return out.withColumn("complete", F.col("n_files") == expected_files)


def _open_parquet(path: str):
    """Parquet file handle for a Spark path, on whichever file system it names."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    if path.startswith("file:") or path.startswith("/"):
        return pq.ParquetFile("/" + path.removeprefix("file:").lstrip("/"))
    for scheme in ("s3a://", "s3n://"):
        if path.startswith(scheme):
            path = "s3://" + path.removeprefix(scheme)
    fs, inner = pafs.FileSystem.from_uri(path)
    return pq.ParquetFile(fs.open_input_file(inner))


def _spread(files: DataFrame) -> DataFrame:
    """Spread file paths over tasks by their number, not by their bytes."""
    n = files.count()
    return files.select("path").repartition(max(1, min(MAX_FOOTER_TASKS, -(-n // FILES_PER_TASK))), "path")


FOOTER_SCHEMA = "path string, row_group int, path_in_schema string, total_compressed_size long, num_values long"


def footers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per file, row group and leaf column, read from footers inside tasks."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                with _open_parquet(path) as f:
                    meta = f.metadata
                    rows = [
                        (path, g, c.path_in_schema, c.total_compressed_size, c.num_values)
                        for g in range(meta.num_row_groups)
                        for c in map(meta.row_group(g).column, range(meta.num_columns))
                    ]
                yield pd.DataFrame(
                    rows, columns=["path", "row_group", "path_in_schema", "total_compressed_size", "num_values"]
                )

    return _spread(file_inventory(spark, paths)).mapInPandas(read, FOOTER_SCHEMA)


RANGE_SCHEMA = "path string, row_group int, least timestamp_ntz, most timestamp_ntz, n_nulls long, all_bytes long, needed_bytes long"


def row_group_ranges(spark: SparkSession, paths: str | Sequence[str], column: str, needed: Sequence[str]) -> DataFrame:
    """Per row group the least and most value of a time column and the bytes of all and of the needed columns, from footers.

    A row group without statistics, or of a file without the column, has null bounds.
    """
    wanted = set(needed)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                with _open_parquet(path) as f:
                    for g in range(f.metadata.num_row_groups):
                        group = f.metadata.row_group(g)
                        cells = [group.column(i) for i in range(group.num_columns)]
                        stats = next((c.statistics for c in cells if c.path_in_schema == column), None)
                        known = stats is not None and stats.has_min_max
                        plain = lambda v: pd.Timestamp(v).tz_localize(None) if known else None
                        sizes = [(c.path_in_schema in wanted, c.total_compressed_size) for c in cells]
                        rows.append((
                            path, g, plain(stats.min) if known else None, plain(stats.max) if known else None,
                            stats.null_count if stats is not None and stats.has_null_count else None,
                            sum(n for _, n in sizes), sum(n for need, n in sizes if need),
                        ))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RANGE_SCHEMA.split(", ")])

    return _spread(file_inventory(spark, paths)).mapInPandas(read, RANGE_SCHEMA)


def surviving_bytes(ranges: DataFrame, start: Column | str, end: Column | str) -> DataFrame:
    """What a read of ``[start, end)`` has to fetch when row groups outside of it are skipped.

    ``n_groups, n_kept, bytes_on_disk, bytes_needed`` (without skipping) and ``bytes_kept``. A row group is skipped only if its
    bounds prove that it holds no row of the window; unknown bounds keep it.
    """
    at = lambda v: F.lit(v).cast("timestamp_ntz") if isinstance(v, str) else v
    outside = (F.col("most") < at(start)) | (F.col("least") >= at(end))
    kept = ~F.coalesce(outside, F.lit(False))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return ranges.agg(
        F.count(F.lit(1)).alias("n_groups"), F.count_if(kept).alias("n_kept"), zero(F.sum("all_bytes")).alias("bytes_on_disk"),
        zero(F.sum("needed_bytes")).alias("bytes_needed"), zero(F.sum(F.when(kept, F.col("needed_bytes")))).alias("bytes_kept"),
    )


def column_footprint(footer_rows: DataFrame, needed: Sequence[str]) -> DataFrame:
    """Compressed bytes per column and whether the projection needs it."""
    return footer_rows.groupBy("path_in_schema").agg(
        F.sum("total_compressed_size").alias("compressed_bytes"),
        F.max(F.col("path_in_schema").isin(list(needed))).alias("needed"),
    )


def byte_totals(footer_rows: DataFrame, needed: Sequence[str]) -> DataFrame:
    """``bytes_on_disk`` of everything and ``bytes_needed`` by the projected columns."""
    size = F.col("total_compressed_size")
    return footer_rows.agg(
        F.coalesce(F.sum(size), F.lit(0)).alias("bytes_on_disk"),
        F.coalesce(F.sum(F.when(F.col("path_in_schema").isin(list(needed)), size)), F.lit(0)).alias("bytes_needed"),
    )


def _fingerprints(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, fingerprint``: the schema of every file as text, read from footers inside tasks."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path in batch["path"]:
                with _open_parquet(path) as f:
                    schema = f.schema_arrow
                    out.append((path, "|".join(f"{c.name}:{c.type}" for c in schema)))
            yield pd.DataFrame(out, columns=["path", "fingerprint"])

    return _spread(file_inventory(spark, paths)).mapInPandas(read, "path string, fingerprint string")


def base_path(path: str) -> str:
    """The folder below which ``name=value`` folders are columns: a pattern's fixed part, or the path itself."""
    fixed = []
    for part in path.split("/"):
        if any(c in part for c in "*?[{"):
            break
        fixed.append(part)
    if len(fixed) == len(path.split("/")):
        return path if not path.endswith(".parquet") else "/".join(fixed[:-1])
    return "/".join(fixed)


def union_by_name(parts: Iterable[DataFrame]) -> DataFrame:
    """Union lined up by column name: case is ignored, absent columns are null, types widen."""
    parts = list(parts)
    out = parts[0]
    for p in parts[1:]:
        have = {c.lower(): c for c in out.columns}
        p = p.select(*(F.col(f"`{c}`").alias(have.get(c.lower(), c)) for c in p.columns))
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Cast to a fixed schema; columns the data lacks become null."""
    have = {c.lower(): c for c in df.columns}

    def pick(f: T.StructField) -> Column:
        c = F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)
        return c.cast(f.dataType).alias(f.name)

    return df.select(*map(pick, contract.fields))


def read_union_by_name(
    spark: SparkSession, paths: str | Sequence[str], contract: T.StructType | None = None
) -> DataFrame:
    """Read files whose schemas drift as one table: one scan per distinct schema, then a union.

    Each given path is read as Spark reads it alone, so ``name=value`` folders below it are columns whether
    schemas drift or not. Schemas are compared in tasks; file names reach the driver only when they drift, as
    the argument that Spark's reader needs.
    """
    parts = []
    for path in [paths] if isinstance(paths, str) else paths:
        found = materialise(_fingerprints(spark, path))
        kinds = [r.fingerprint for r in found.groupBy("fingerprint").agg(F.min("path").alias("first")).sort("first").collect()]
        if len(kinds) <= 1:
            parts.append(spark.read.parquet(path))
            continue
        reader = spark.read.option("basePath", base_path(path))
        for kind in kinds:
            names = [r.path for r in found.filter(F.col("fingerprint") == kind).select("path").toLocalIterator()]
            parts.append(reader.parquet(*names))
    out = union_by_name(parts)
    return conform(out, contract) if contract else out


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """CSV with a header; types are inferred from the whole file unless a schema is given."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def csv_to_parquet(
    spark: SparkSession, csv_path: str, out_path: str, columns: Sequence[str], schema: str | None = None
) -> DataFrame:
    """Project columns of a CSV file and store them once as Parquet."""
    read_csv(spark, csv_path, schema).select(*columns).write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)
