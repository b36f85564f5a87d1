"""Corpus preparation: five stages from raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes every stage's result as Parquet in the
shared work folder and hands the stored table to the next one, so a lost executor repeats part of one stage at
most. All stages but the last return the columns of ``documents``, whatever other columns it has.

Null texts count as empty and stay null where they are kept; rows with null or repeated ids are rows like others (a null id
is never held out and labels nothing); no documents give no rows at any stage.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from zoneflow.llm import exact_dedup, near_dedup, packing, quality, suffix_dedup
from zoneflow.llm.common import materialise

VOCABULARIES = os.path.dirname(public_tokenizers.__file__)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model scores 0.3 or higher; it learns from the labels that are not held out.

    Empty and null texts have one score, that of all-zero features. Without labels the score is the same for all.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train(docs, labels))


def exact_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group with equal texts; null equals empty.

    Of rows that share text and smallest id one stays; a null id stays only where all ids of the group are null.
    """
    return exact_dedup.drop_exact_copies(docs)


def near_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: five-word shingles, similarity 0.8 or more.

    Documents without words are in no class and stay. The smallest id of a class stays, a null id only if all are null.
    """
    return near_dedup.drop_near_copies(docs, shingle=5, percent=80)


def repeat_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the characters that repeated strings of 200 bytes cover; null texts stay null."""
    return suffix_dedup.drop_repeats(docs, chars_col="n_chars" if "n_chars" in docs.columns else None)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens; an empty or null text is its end token alone."""
    pieces = packing.pack_documents(docs, f"{VOCABULARIES}/word_bpe_49k.json")
    return packing.piece_digests(pieces).withColumnRenamed("id", "doc_id")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_filter),
    ("exact_dedup", exact_filter),
    ("near_dedup", near_filter),
    ("suffix_dedup", repeat_filter),
    ("packing", pack),
]

# Learned scores, MinHash candidates and token ids have no SQL form; tests hold every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is that of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
