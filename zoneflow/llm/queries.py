"""The registered queries of this package: each operator on its whole table, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm import bpe, exact_dedup, langid, near_dedup, packing, prefix_trie, quality, suffix_dedup, token_counts, topk, toxicity, turn_repair, url_filter

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


# Where the public vocabulary files lie; operators take the path as a parameter.
VOCABULARIES = os.path.dirname(public_tokenizers.__file__)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_counts(spark, sf):
    """Tokens of every document."""
    docs = table(spark, sf, "documents")
    return token_counts.count_tokens(docs, f"{VOCABULARIES}/piece_bpe_32k.model").withColumnRenamed("id", "doc_id")


@query
def op2_bpe(spark, sf):
    """Every document encoded with the lexicon of its corpus, and decoded again."""
    docs, vocabulary = table(spark, sf, "documents"), f"{VOCABULARIES}/byte_bpe_50k.json"
    with open(vocabulary, encoding="utf-8") as f:
        lexicon = bpe.build_lexicon(docs, f.read())
    return bpe.round_trip(docs, vocabulary, lexicon=lexicon).withColumnRenamed("id", "doc_id")


@query
def op3_quality(spark, sf):
    """Every document scored by a model that is learnt from the labels outside the held-out fold."""
    docs = table(spark, sf, "documents")
    model = quality.train(docs, table(spark, sf, "labels"))
    return quality.score_documents(docs, model).withColumnRenamed("id", "doc_id")


@query
def op4_packing(spark, sf):
    """All documents packed into sequences of at most 4096 tokens."""
    pieces = packing.pack_documents(table(spark, sf, "documents"), f"{VOCABULARIES}/word_bpe_49k.json")
    return packing.piece_digests(pieces).withColumnRenamed("id", "doc_id")


@query
def op5_suffix_dedup(spark, sf):
    """Every byte that a repeated string of 200 bytes covers, over all documents."""
    found = suffix_dedup.repeat_spans(table(spark, sf, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op6_url_filter(spark, sf):
    """Rules, and block decisions carried along canonical links and redirects, for every page."""
    return url_filter.judge_urls(table(spark, sf, "pages"), URL_RULES).withColumnRenamed("id", "page_id")


@query
def op7_exact_dedup(spark, sf):
    """Groups of identical texts over all documents."""
    return exact_dedup.exact_groups(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


@query
def op8_language(spark, sf):
    """Language of every document, learnt outside the held-out fold."""
    docs = table(spark, sf, "documents")
    return langid.predict_language(docs, langid.train(docs)).withColumnRenamed("id", "doc_id")


@query
def op9_near_dedup(spark, sf):
    """Classes of near copies over all documents: three-word shingles, similarity 0.85."""
    found = near_dedup.near_duplicates(table(spark, sf, "documents"), shingle=3, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


@query
def op10_topk(spark, sf):
    """Ten best inner products over all vectors for every hundredth one."""
    vectors = table(spark, sf, "embeddings")
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0).withColumnRenamed("id", "vec_id")


@query
def op11_prefix_trie(spark, sf):
    """Every distinct prefix of the rebuilt conversations, with its members and what its subtree holds."""
    return prefix_trie.prefix_trie(table(spark, sf, "conversations"))


@query
def op12_turn_repair(spark, sf):
    """Faults and the cheapest repair of every damaged conversation."""
    return turn_repair.damage_and_repair(table(spark, sf, "conversations"))


@query
def op13_toxicity(spark, sf):
    """Every document scored for abuse by a lexicon and a model that are learnt outside the held-out fold."""
    docs = table(spark, sf, "documents")
    model = toxicity.train(docs, table(spark, sf, "labels"))
    return toxicity.score_documents(docs, model).withColumnRenamed("id", "doc_id")
