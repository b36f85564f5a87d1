"""Quality and language models: held-out accuracy, odd rows, and the pieces of the fits."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneflow.llm import langid, quality
from conftest import SF


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def model(docs, labels):
    return quality.train(docs, labels)


def test_quality_on_held_out_labels(docs, labels, model):
    rows = quality.score_documents(docs, model).join(labels.withColumnRenamed("doc_id", "id"), "id").filter("held_out").collect()
    assert len(rows) > 40
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_quality_depends_on_the_text_alone(spark, docs, labels, model):
    one = docs.select((F.col("doc_id") + 1_000_000).alias("doc_id"), "text", F.lit("zz").alias("lang"), F.lit(None).alias("score"))
    a = {r.id: r.score for r in quality.score_documents(docs, model).collect()}
    b = {r.id - 1_000_000: r.score for r in quality.score_documents(one, model).collect()}
    assert a == b
    held = docs.filter("crc32(cast(doc_id as string)) % 5 = 0")
    assert {r.id for r in quality.score_documents(docs, model).filter("held_out").collect()} == {r.doc_id for r in held.collect()}
    # labels of the held-out fold change nothing
    other = labels.withColumn("quality", F.when(F.expr("crc32(cast(doc_id as string)) % 5 = 0"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.train(docs, other)
    assert all(np.array_equal(x, y) for x, y in zip(model.tables, again.tables))


def test_quality_of_odd_rows(spark, model):
    df = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "", 2), (2, "x " * 300_000, 3)], "doc_id long, text string, held_out int")
    rows = quality.score_documents(df, model).collect()
    assert len(rows) == 4 and len({r.score for r in rows if r.id != 2}) == 1
    assert [r.held_out for r in rows if r.id is None] == [False]
    assert quality.score_documents(df.limit(0), model).collect() == []
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns
    assert kept.count() == sum(r.predicted for r in rows)


def test_quality_without_labels(spark, docs, labels):
    none = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score_documents(docs, none).collect()} == {0.5}
    null = quality.train(docs, spark.createDataFrame([(None, 1), (5, None), (6, 1), (6, 1)], "doc_id long, quality int"))
    assert len({r.score for r in quality.score_documents(docs, null).collect()}) == 1


def test_quality_sample_is_bounded(docs, labels, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append(len(y)))
    quality.train(docs, labels, max_rows=50)
    assert 20 <= seen[0] <= 50


def test_pairs_learn_what_single_features_cannot():
    r = np.random.default_rng(1)
    x = r.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality.fit(x, y)
    assert m.pairs[0] == (0, 1)
    assert np.mean((m.score(x) > 0.5) == y) > 0.95
    by_hand = m.intercept + sum(t[np.searchsorted(e, x[:5, j], "right")] for j, (e, t) in enumerate(zip(m.edges, m.tables)))
    for (i, j), t in zip(m.pairs, m.pair_tables):
        by_hand = by_hand + [t[np.searchsorted(m.pair_edges[i], a, "right"), np.searchsorted(m.pair_edges[j], b, "right")] for a, b in x[:5, [i, j]]]
    assert np.allclose(m.margin(x[:5]), by_hand)


def test_best_cut_is_the_best():
    r = np.random.default_rng(2)
    g, h = r.normal(size=9), r.random(9)
    gain = lambda a, b: a.sum() ** 2 / (b.sum() + 2)
    every = [gain(g[:i], h[:i]) + gain(g[i:], h[i:]) - gain(g, h) for i in range(1, 9)]
    got, at = quality._best_cut(g, h, 0, 9, 2.0)
    assert at == 1 + int(np.argmax(every)) and abs(got - max(every)) < 1e-12


@pytest.fixture(scope="module")
def languages(docs):
    return langid.train(docs)


def test_language_on_held_out_rows(docs, languages):
    rows = langid.predict_language(docs, languages).join(docs.select(F.col("doc_id").alias("id"), "lang"), "id").filter("held_out").collect()
    assert len(rows) > 200 and np.mean([r.lang_pred == r.lang for r in rows]) > 0.98
    assert np.mean([r.rejected for r in rows]) < 0.1 and all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark, languages):
    texts = [None, "", " 12 .,! ", "の", "the", "The " * 400_000, "the\x00"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, "der die das")], "doc_id long, text string")
    got = {r.id: r for r in langid.predict_language(df, languages).collect()}
    assert [got[i].lang_pred for i in range(3)] == ["und"] * 3 and all(got[i].score == 0 and got[i].rejected for i in range(3))
    assert got[3].lang_pred in languages.languages
    assert got[4].lang_pred == got[5].lang_pred == "en" and not got[None].held_out
    assert langid.predict_language(df.limit(0), languages).collect() == []


def test_scores_do_not_depend_on_the_batch(docs, languages, monkeypatch):
    texts = [r.text for r in docs.limit(60).collect()]
    together = languages.scores(texts)
    alone = np.concatenate([languages.scores([t]) for t in texts])
    monkeypatch.setattr(langid, "_RUN_BYTES", 700)
    sliced = languages.scores(texts)
    assert np.allclose(together, alone, atol=1e-5) and np.allclose(together, sliced, atol=1e-5)


def test_language_without_rows(spark, docs):
    none = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.predict_language(docs.limit(5), none).collect()} == {"und"}
    one = langid.train(docs.filter("lang = 'fr'"))
    assert {r.lang_pred for r in langid.predict_language(docs.limit(5), one).collect()} == {"fr"}


def test_language_sample_is_bounded(docs, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "fit", lambda texts, langs: seen.append(langs))
    langid.train(docs, per_language=20)
    counts = {k: seen[0].count(k) for k in set(seen[0])}
    assert len(counts) == 4 and all(5 <= n <= 20 for n in counts.values())


def test_language_texts_stay_in_the_tasks(spark, docs, monkeypatch):
    """Long texts and copies: the driver gets bounded features, and the model is the one of the texts themselves."""
    few = docs.filter("lang IS NOT NULL").select("doc_id", "text", "lang").limit(150)
    long = F.when(F.col("doc_id") % 20 == 0, F.repeat("text", 1000)).otherwise(F.col("text")).alias("text")
    few = few.select("doc_id", long, "lang")
    few = spark.createDataFrame([tuple(r) for r in few.unionAll(few.limit(10)).collect()], "doc_id long, text string, lang string")
    place = F.shiftrightunsigned(F.xxhash64(F.lit("train"), "doc_id"), 2)
    rows = few.filter("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1").withColumn("place", place).collect()
    rows.sort(key=lambda r: (r.lang, r.place))
    want = langid.fit([r.text for r in rows], [r.lang for r in rows])
    received, whole = [], type(few).toLocalIterator

    def counted(df, *more):
        for r in whole(df, *more):
            received.append(sum(len(v) if isinstance(v, (str, bytes, bytearray)) else 8 for v in r))
            yield r

    monkeypatch.setattr(type(few), "toLocalIterator", counted)
    got = langid.train(few)
    assert received and max(received) <= 6 << langid.BUCKET_BITS
    assert max(len(r.text) for r in rows) > 6 << langid.BUCKET_BITS
    assert got.languages == want.languages and (got.temperature, got.reject_below) == (want.temperature, want.reject_below)
    assert np.array_equal(got.weights, want.weights) and np.array_equal(got.bias, want.bias)


def plain_features(text):
    """The quality features, character by character and word by word."""
    raw, words, lines = text.encode(), text.split(), text.split("\n")
    if not raw:
        return [0.0] * 18
    size, n = len(raw), max(1, len(words))
    share = lambda test: sum(1 for b in raw if test(b)) / size
    among = lambda chars: share(lambda b: chr(b) in chars)
    once = lambda items: len(set(items))
    pairs = list(zip(words, words[1:]))
    return [
        math.log(1 + size), share(lambda b: 65 <= b <= 90), share(lambda b: 97 <= b <= 122), share(lambda b: 48 <= b <= 57), among(" \t"),
        among(".,;:'()?-"), among('!"#$%&*+/<=>@[\\]^_`{|}~'), share(lambda b: b >= 128), among("\n"), min(60.0, len(text) / n),
        sum(w.isupper() and len(w) > 1 for w in words) / n, once(words) / n, once(pairs) / n, sum(a == b for a, b in pairs) / n,
        max((words.count(w) for w in set(words)), default=0) / n, once(lines) / len(lines), sum(len(w) < 4 for w in words) / n,
        1 - sum(w[-1].isalnum() for w in words) / n,
    ]


def test_quality_scores_equal_the_slow_ones(docs, model):
    """Each feature counted by hand, each table looked up by a linear search, all added up."""

    def bin_of(edges, x):
        return sum(e <= x for e in edges)

    def margin(x):
        out = model.intercept + sum(t[bin_of(e, v)] for e, t, v in zip(model.edges, model.tables, x))
        return out + sum(t[bin_of(model.pair_edges[i], x[i]), bin_of(model.pair_edges[j], x[j])] for (i, j), t in zip(model.pairs, model.pair_tables))

    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    texts = {i: t for i, t in texts.items() if len(t) < 4000}
    got = {r.id: r for r in quality.score_documents(docs, model).collect()}
    assert len(texts) > 100
    for i, t in texts.items():
        slow = plain_features(t)
        assert quality.text_features(t) == pytest.approx(slow, rel=1e-12, abs=1e-12)
        score = 1 / (1 + math.exp(-margin(quality.text_features(t))))
        assert got[i].score == pytest.approx(score, rel=1e-9) and got[i].predicted == int(score >= 0.3)


def test_language_scores_equal_the_slow_ones(docs, languages):
    """Every piece of three and four bytes hashed, looked up and averaged one after the other."""

    def probabilities(text):
        raw = b" " + bytes(b if b > 127 or chr(b).isalpha() else 32 for b in text.lower().encode()) + b"    "
        sums, n = np.zeros(len(languages.languages)), 0
        for at in range(len(raw) - 4):
            if raw[at : at + 2] != b"  ":
                for size, factor in ((3, 0x9E3779B1), (4, 0x85EBCA6B)):
                    number = int.from_bytes(raw[at : at + size], "little")
                    sums += languages.weights[(number * factor % 2**32) >> (32 - langid.BUCKET_BITS)]
                    n += 1
        z = np.exp((sums / max(1, n) + languages.bias) / languages.temperature)
        return z / z.sum()

    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = {r.id: r for r in langid.predict_language(docs, languages).collect()}
    short = {i: t for i, t in texts.items() if len(t) < 600}
    assert len(short) > 30
    for i, t in short.items():
        p = probabilities(t)
        if not any(c.isalpha() for c in t):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
        else:
            assert got[i].lang_pred == languages.languages[int(p.argmax())] and got[i].score == pytest.approx(p.max(), rel=1e-5)
