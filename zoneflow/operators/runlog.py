"""Metrics blocks: writing, parsing, ledger rows, line counts, run checks."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions.formats import (
    BLOCK_END,
    BLOCK_MARK,
    BLOCK_VERSION,
    EXECUTOR_MARK,
    HEADER_END,
    LEDGER_COLUMNS,
    LINK_GBIT_PER_S,
    PINNED_PARTITIONS,
)

# Block layout. Header pairs on the first line, one pair per body line.
_BEGIN = re.compile(rf"{BLOCK_MARK} v([\d.]+) ")
# Blocks handed back to Spark at once.
BATCH_BLOCKS = 10_000


def _pairs(entries: Mapping[str, Column], sep: str) -> Column:
    return F.concat_ws(
        sep, *(F.concat(F.lit(f"{k}="), F.coalesce(v.cast("string"), F.lit("None"))) for k, v in entries.items())
    )


def block_text(header: Mapping[str, Column], body: Mapping[str, Column]) -> Column:
    """One metrics block as text."""
    return F.concat(
        F.lit(f"{BLOCK_MARK} v{BLOCK_VERSION} "), _pairs(header, " "), F.lit(f"{HEADER_END}\n"),
        _pairs(body, "\n"), F.lit(f"\n{BLOCK_END}"),
    )


def _block_pairs(text: str) -> Iterator[dict[str, str]]:
    """Pairs of each block of a text, those that come last first.

    A block's header ends at the first header end, its body at the first block end behind that; a mark without a version is none.
    """
    at = _BEGIN.search(text)
    while at:
        head = text.find(f"{HEADER_END}\n", at.end())
        body = head + len(f"{HEADER_END}\n")
        end = text.find(f"\n{BLOCK_END}", body) if head >= 0 else -1
        if end < 0:
            return
        lines = text[at.end() : head].split() + text[body:end].strip().splitlines()
        pairs = [["listener_version", at[1]], *(s.split("=", 1) for s in lines if "=" in s)]
        kv = dict(reversed(pairs))
        if len(kv) < len(pairs):
            kv.update(pairs)
        yield kv
        at = _BEGIN.search(text, end + len(f"\n{BLOCK_END}"))


def parse_blocks(logs: DataFrame, text: str = "text", keep: Sequence[str] = ("path",)) -> DataFrame:
    """``keep, block, kv``: one row per block with its pairs as a map.

    A pair is cut at its first ``=``. Body lines without ``=`` are skipped, a later line overrides an
    earlier one and the body overrides the header. Works per row without a shuffle.
    """
    rows = logs.select(*keep, F.col(text).cast("string").cast("binary").alias("__text"))
    schema = T.StructType([*rows.drop("__text").schema.fields, *T.StructType.fromDDL("block int, kv map<string, string>").fields])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, block, ends, keys, values = [], [], [0], [], []

            def batch() -> pa.RecordBatch:
                kv = pa.MapArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys, pa.string()), pa.array(values, pa.string()))
                kept = [c.take(pa.array(row, pa.int64())) for c in b.columns[:-1]]
                return pa.RecordBatch.from_arrays([*kept, pa.array(block, pa.int32()), kv], schema.names)

            for i, raw in enumerate(b.column(b.num_columns - 1).to_pylist()):
                for n, kv in enumerate(_block_pairs((raw or b"").decode("utf-8", "replace"))):
                    row.append(i)
                    block.append(n)
                    keys.extend(kv)
                    values.extend(kv.values())
                    ends.append(len(keys))
                    if len(row) == BATCH_BLOCKS:
                        yield batch()
                        row, block, ends, keys, values = [], [], [0], [], []
            if row:
                yield batch()

    return rows.mapInArrow(mapped, schema)


def ledger_rows(
    blocks: DataFrame, resource_id: Column | str, nodes: Column | int, startup_s: Column | str = "", keep: Sequence[str] = ()
) -> DataFrame:
    """The twelve ledger columns as text; what a block lacks, and what is filled in by hand, is empty."""
    as_text = lambda v: F.coalesce((v if isinstance(v, Column) else F.lit(v)).cast("string"), F.lit(""))
    given = {"resource_id": resource_id, "nodes": nodes, "startup_s": startup_s, "predicted_s": "", "cost_usd": ""}
    value = lambda c: as_text(given[c]) if c in given else F.coalesce(F.col("kv")[c], F.lit(""))
    return blocks.select(*keep, *(value(c).alias(c) for c in LEDGER_COLUMNS))


def ledger_lines(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Ledger rows as comma-joined lines, unquoted."""
    return rows.select(*keep, F.concat_ws(",", *LEDGER_COLUMNS).alias("line"))


def write_ledger(rows: DataFrame, path: str) -> None:
    """Ledger as CSV files with the header and empty cells for missing values."""
    out = rows.select(*(F.col(c).cast("string").alias(c) for c in LEDGER_COLUMNS)).na.fill("")
    out.write.mode("overwrite").option("header", True).option("emptyValue", "").option("quoteAll", False).csv(path)


def read_ledger(spark, path: str) -> DataFrame:
    """Ledger files as text columns, empty cells as null."""
    schema = ", ".join(f"{c} string" for c in LEDGER_COLUMNS)
    return spark.read.option("header", True).schema(schema).csv(path)


def line_counts(lines: DataFrame, markers: Mapping[str, str], by: Sequence[str] = ("path",)) -> DataFrame:
    """Lines per file that contain each marker text."""
    return lines.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_lines"),
        *(F.count_if(F.col("line").contains(m)).alias(name) for name, m in markers.items()),
    )


def lines_with_prefix(lines: DataFrame, prefixes: Sequence[str], display_width: int | None = None) -> DataFrame:
    """Whole lines that start with one of the prefixes; ``display_width`` cuts them for a screen."""
    starts = F.lit(False)
    for p in prefixes:
        starts = starts | F.col("line").startswith(p)
    found = lines.filter(starts)
    return found if display_width is None else found.withColumn("line", F.substring("line", 1, display_width))


def _all_true(c: Column) -> Column:
    """True when the condition holds for every block it applies to (null means not applicable)."""
    return F.coalesce(F.every(c), F.lit(True))


def run_checks(runs: DataFrame, blocks: DataFrame, executors: DataFrame | None = None) -> DataFrame:
    """Per log of ``runs``: is the run complete and comparable? A log without any block is a failed run.

    ``runs`` has one row per log: ``path``, and where they are known ``nodes`` (executors the run should
    have gained) and ``pin`` (its pinned partition count); a null or absent pin is the usual one.

    ``blocks_ok``  the number of blocks the kind of run prints: 1 for a single-machine scan, else 2
    ``mode_ok``    Spark blocks read ``mode=rest`` and name the host that answered
    ``retried_ok`` Spark blocks read ``retried=0``
    ``pin_ok``     the pinned partition count reached phase A's ``partitions``
    ``bytes_ok``   ``0 < bytes_needed < bytes_on_disk`` in a scan block
    ``rate_ok``    a scan block's read rate is below the network's advertised rate
    ``executors_ok`` the driver log names one executor per node; null (not asked) of scans and where
    ``nodes`` is not known
    """
    kv = F.col("kv")
    num = lambda k: kv[k].try_cast("double")
    scan = F.coalesce(kv["mode"] == "duckdb", F.lit(False))
    when_spark = lambda c: F.when(~scan, F.coalesce(c, F.lit(False)))
    when_scan = lambda c: F.when(scan, F.coalesce(c, F.lit(False)))
    given = lambda c, kind: F.col(c).cast(kind) if c in runs.columns else F.lit(None).cast(kind)
    runs = runs.select("path", given("nodes", "long").alias("nodes"), F.coalesce(given("pin", "double"), F.lit(PINNED_PARTITIONS)).alias("pin"))
    # the executor log is asked of runs, so it joins their list and not their blocks
    blocks = blocks.select("path", "kv").join(runs.select("path", "pin"), "path")
    pin = num("shuffle_partitions") == F.col("pin")
    pin_a = F.when(kv["phase"] == "A_aggregate", num("partitions") == F.col("pin")).otherwise(F.lit(True))
    gbit_per_s = num("bytes_needed") * 8 / F.lit(1e9) / F.greatest(num("t_read_s"), F.lit(1e-9))
    flags = blocks.groupBy("path").agg(
        F.count(F.lit(1)).alias("n_blocks"),
        F.every(scan).alias("scan"),
        (F.count(F.lit(1)) == F.when(F.every(scan), 1).otherwise(2)).alias("blocks_ok"),
        _all_true(when_spark((kv["mode"] == "rest") & (kv["rest_target"] != "none"))).alias("mode_ok"),
        _all_true(when_spark(kv["retried"] == "0")).alias("retried_ok"),
        _all_true(when_spark(pin & pin_a)).alias("pin_ok"),
        _all_true(
            when_scan((num("bytes_needed") > 0) & (num("bytes_needed") < num("bytes_on_disk")))
        ).alias("bytes_ok"),
        _all_true(when_scan(gbit_per_s < LINK_GBIT_PER_S)).alias("rate_ok"),
    )
    checks = ["blocks_ok", "mode_ok", "retried_ok", "pin_ok", "bytes_ok", "rate_ok"]
    flags = runs.join(flags, "path", "left").withColumns(
        {
            "n_blocks": F.coalesce("n_blocks", F.lit(0).cast("long")),
            "blocks_ok": F.coalesce("blocks_ok", F.lit(False)),
            **{c: F.coalesce(c, F.lit(True)) for c in checks[1:]},
        }
    )
    if executors is not None:
        seen = F.coalesce(F.col("n_executors"), F.lit(0)) == F.col("nodes")
        flags = flags.join(executors.select("path", "n_executors"), "path", "left")
        flags = flags.withColumn("executors_ok", F.when(~F.coalesce("scan", F.lit(False)), seen))
        checks.append("executors_ok")
    ok = F.lit(True)
    for c in checks:
        ok = ok & F.coalesce(c, F.lit(True))
    return flags.select("path", "n_blocks", *checks, ok.alias("valid"))


def executor_counts(lines: DataFrame) -> DataFrame:
    """``path, n_executors`` from driver log lines."""
    return line_counts(lines, {"n_executors": EXECUTOR_MARK}).select("path", "n_executors")
