"""Each stage of the pipeline on its own input, against a plain version of the stage."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from plain import exact_groups, near_classes, repeat_spans
from pyspark.sql import functions as F
from test_packing_topk_urls import check_pieces
from tokenizers import Tokenizer

import corpus_pipeline
from zoneflow.llm import packing, quality
from zoneflow.llm.common import materialise


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out.append(materialise(stage(spark, out[-1], SF_SMALL)))
    return out


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(results):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "suffix_dedup", "packing"]
    assert all(r.columns == results[0].columns for r in results)
    assert [r.count() for r in results] == sorted((r.count() for r in results), reverse=True)


def test_quality_stage(spark, results):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = quality.train(results[0], labels)
    before = rows_of(results[0])
    good = {i for i, r in before.items() if model.score(quality.feature_rows([r.text]))[0] >= 0.3}
    assert rows_of(results[1]) == {i: before[i] for i in good}
    marked = {r.doc_id: r.quality for r in labels.collect()}
    assert np.mean([(i in good) == (q == 1) for i, q in marked.items()]) > 0.95


def test_exact_stage(results):
    before = rows_of(results[1])
    groups = exact_groups({i: r.text for i, r in before.items()})
    assert rows_of(results[2]) == {i: before[i] for i in {g[0] for g in groups.values()}}


def test_near_stage(results):
    before = rows_of(results[2])
    classes = near_classes({i: r.text for i, r in before.items()}, 5, 80)
    assert rows_of(results[3]) == {i: before[i] for i in {c for _, c in classes.values()}}


def test_repeat_stage(results):
    before, after = rows_of(results[3]), rows_of(results[4])
    assert before.keys() == after.keys()
    for i, spans in repeat_spans({i: r.text for i, r in before.items()}, 200).items():
        at, kept = 0, []
        for c in before[i].text:
            n = len(c.encode())
            kept.append("" if any(a <= at and at + n <= b for a, b in spans) else c)
            at += n
        assert after[i].text == "".join(kept)
        assert (after[i].lang, after[i].source) == (before[i].lang, before[i].source)


def test_pack_stage(spark, results):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*tok.encode(r.text, add_special_tokens=False).ids, 2] for i, r in rows_of(results[4]).items()}
    pieces = corpus_pipeline.STAGES[-1][1](spark, results[4], SF_SMALL).withColumnRenamed("doc_id", "id").collect()
    check_pieces(pieces, ids)
    assert packing.GROUP_BYTES > 0


def test_run(spark, results):
    whole = corpus_pipeline.run(spark, SF_SMALL)
    assert {r.doc_id for r in whole.select("doc_id").distinct().collect()} == set(rows_of(results[4]))


def test_stages_on_odd_rows(spark):
    """Null ids and texts, empty, repeated and very long ones, other columns with the helpers' names, and no rows at all."""
    good = [r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(30).collect()]
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in good]
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows += [(None, None, None, None, None), (None, "", "en", "s", 0), (1000, None, "en", "s", None), (1001, "", None, "s", 0), (1002, long, "en", "s", len(long))]
    rows += [rows[0], (1003, *rows[0][1:]), (None, *rows[0][1:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    for c in ("row", "part", "id", "t", "x", "node", "fp", "hit"):
        docs = docs.withColumn(c, F.lit("other"))
    docs = materialise(docs)
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [tuple(r) for r in docs.collect()]
        docs, empty = materialise(stage(spark, docs, SF_SMALL)), stage(spark, empty, SF_SMALL)
        assert docs.columns == empty.columns and docs.count() > 20 and empty.count() == 0, name
        after = [tuple(r) for r in docs.collect()]
        if name != "suffix_dedup":
            assert not Counter(after) - Counter(before)
        else:
            assert sorted(map(str, ((r[0], *r[5:]) for r in after))) == sorted(map(str, ((r[0], *r[5:]) for r in before)))
        if name == "exact_dedup":
            plain = lambda t: " ".join((t or "").split())
            texts = Counter(plain(r[1]) for r in after)
            assert set(texts) == {plain(r[1]) for r in before} and max(texts.values()) == 1
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert sum(r.length for r in pieces) >= docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF_SMALL).count() == 0
