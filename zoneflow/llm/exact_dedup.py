"""Exact duplicates by two passes of Bloom filtering, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import cell, materialise, text_or_empty
from zoneflow.sources.workdir import broadcast_if_small

# Counting slots per row. With two slots a row, a text that occurs once is sent on by mistake in about
# one case in sixty; that costs a shuffled row of 60 bytes and never a wrong answer.
SLOTS_PER_ROW = 16


def normalised(text: Column) -> Column:
    """Every run of white space (blank, tab to carriage return) becomes one blank."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def _slots(fp: Column, words: int) -> list[Column]:
    """Word and bit pair of a fingerprint: a blocked filter keeps both bits in one 64-bit word."""
    h = F.xxhash64(fp)
    return [
        F.pmod(h, F.lit(words)).alias("word"),
        F.shiftrightunsigned(h, 52).bitwiseAND(63).cast("int").alias("bit1"),
        F.shiftrightunsigned(h, 58).bitwiseAND(63).cast("int").alias("bit2"),
    ]


def repeated_filter(prints: DataFrame, fp: str, words: int) -> DataFrame:
    """First pass: Bloom filter ``(word, bits)`` of the slots that two or more rows hit.

    A row adds one to each of its distinct slots (a counting filter). With so many slots the counts hardly combine
    before the shuffle, so up to two narrow rows a document move; only counts above one leave a bit. A fingerprint held by two rows therefore always has all its bits set.
    """
    hit = prints.select(*_slots(F.col(fp), words)).select(
        "word", F.explode(F.array_distinct(F.array("bit1", "bit2"))).alias("bit")
    )
    twice = hit.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return twice.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One narrow row per document: ``(row_no, id, fp)`` with the SHA-256 of the normalised text."""
    return docs.select(
        F.monotonically_increasing_id().alias("row_no"),
        cell(id_col).alias("id"),
        F.unhex(F.sha2(normalised(text_or_empty(text_col)).cast("binary"), 256)).alias("fp"),
    )


def split_by_filter(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Second pass: ``(possibly repeated, certainly single)`` rows of a stored fingerprint table.

    The filter is sent to the executors when its measured size is small, and is joined by its word
    beyond that; then narrow rows move, never texts.
    """
    words = max(64, prints.count() * SLOTS_PER_ROW // 64)
    bloom = broadcast_if_small(materialise(repeated_filter(prints, "fp", words)))
    names = prints.columns
    tested = prints.select("*", *_slots(F.col("fp"), words)).join(bloom, "word", "left")
    both = F.expr("coalesce(getbit(bits, bit1) = 1 AND getbit(bits, bit2) = 1, false)")
    return tested.filter(both).select(*names), tested.filter(~both).select(*names)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row ``(id, keep_id, group_size, kept, text_sha256)``.

    Rows are equal when their texts are identical after white-space runs become one blank; null counts
    as empty. ``keep_id`` is the smallest id of the group (null only if all its ids are null); exactly one
    row of a group has ``kept``, also when several rows share the smallest id. Empty input gives no rows.

    Texts never move: a first pass stores fingerprints and builds the filter, which shuffles its slots (see
    ``repeated_filter``); rows that fail it pass straight through, unless the filter is too large to be sent and is
    joined. After that only possibly repeated rows (id and fingerprint) are shuffled; their minima and counts
    are combined before that, so a group holding a third of all rows is a few rows per task.
    """
    prints = materialise(fingerprints(docs, id_col, text_col))
    maybe, single = split_by_filter(prints)
    first = F.min(F.struct(F.isnull("id").alias("no_id"), F.col("id"), F.col("row_no"))).alias("first")
    # stored, so that the join below has a table of its own to meet and can split a hot group
    groups = materialise(maybe.groupBy("fp").agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1"))
    grouped = maybe.join(broadcast_if_small(groups), "fp", "left").select(
        "id",
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (F.col("n").isNull() | (F.col("row_no") == F.col("first.row_no"))).alias("kept"),
        F.lower(F.hex("fp")).alias("text_sha256"),
    )
    return single.select(
        "id",
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.lower(F.hex("fp")).alias("text_sha256"),
    ).unionAll(grouped)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; the same choice as ``exact_groups``.

    Of rows that share both the smallest id and the text any one stays. Texts of rows outside repeated
    groups do not move.
    """
    prints = materialise(fingerprints(docs, id_col, text_col))
    maybe, _ = split_by_filter(prints)
    first = F.min(F.struct(F.isnull("id").alias("no_id"), F.col("id"))).alias("first")
    groups = maybe.groupBy("fp").agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = broadcast_if_small(materialise(groups.select("fp", F.col("first.id").alias("keep_id"))))
    names = docs.columns
    # one struct keeps the input's columns apart from the helper columns, whatever they are called
    rows = docs.select(
        F.struct(*(cell(c) for c in names)).alias("row"),
        cell(id_col).alias("id"),
        F.unhex(F.sha2(normalised(text_or_empty(text_col)).cast("binary"), 256)).alias("fp"),
    ).join(groups.withColumn("hit", F.lit(True)), "fp", "left")
    alone = rows.filter("hit IS NULL").select("row.*")
    stays = rows.filter(F.col("hit") & F.col("id").eqNullSafe(F.col("keep_id"))).dropDuplicates(["fp"])
    return alone.unionAll(stays.select("row.*"))
