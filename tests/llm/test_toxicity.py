"""The lexicon automaton, contexts and the trained model against slow, obvious versions and held-out labels."""

import math
import random
import zlib

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from zoneflow.llm import toxicity as tox


def distance(a, b):
    """Insertions, deletions, replacements and swaps of neighbours, by the usual table; to every beginning of ``b``."""
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[len(a)]


def nearest(terms, word):
    found = []
    for i, t in enumerate(terms):
        row = distance(t.rstrip("*"), word)
        e = min(row) if t.endswith("*") else row[-1]
        if e <= tox.edits_allowed(t):
            found.append((e, i))
    return tuple(reversed(min(found))) if found else None


@pytest.mark.parametrize("seed", range(3))
def test_automaton_finds_the_nearest_term(seed):
    r = random.Random(seed)
    word = lambda lo, hi: "".join(r.choice("abcd") for _ in range(r.randrange(lo, hi)))
    terms = sorted({word(3, 12) + r.choice(["", "", "*"]) for _ in range(25)})
    match = tox.make_matcher(terms)
    hits = 0
    for _ in range(1500):
        w = word(1, 13)
        if r.random() < 0.7:
            w = r.choice(terms).rstrip("*") + r.choice(["", word(0, 4)])
            for _ in range(r.randrange(3)):
                at = r.randrange(len(w) + 1)
                w = r.choice([w[:at] + r.choice("abcd") + w[at:], w[:at] + w[at + 1 :], w[:at] + w[at + 1 : at + 2] + w[at : at + 1] + w[at + 2 :]])
        assert match(w) == nearest(terms, w), w
        hits += match(w) is not None
    assert 200 < hits < 1500


def test_disguised_and_long_words():
    match = tox.make_matcher(["idiot", "scum"])
    assert match("idiot") == (0, 0) and match("1d1ot") == (0, 1) and match("idi0t") == (0, 1) and match("$cum") == (1, 1)
    assert match("scam") is None and match("2024") is None and match("") is None and match("idiot" * 20) is None
    assert tox.words_of("An idi*t, o'clock! scum_scum") == ["an", "idi*t", "o'clock", "scum", "scum"]


def test_quotation_is_told_from_abuse():
    for text, quoted in [
        ('you idiot', False), ('she wrote "you idiot" to them', True), ("he said “idiot” twice", True), ("er sagte „idiot“", True),
        ('"first" you idiot "second"', False), ("« pauvre idiot »", True), ('5" wide, idiot', False), ('a "b\nidiot" c', False),
    ]:
        at = text.index("idiot")
        assert tox.is_quoted(text.lower(), at, at + 5) is quoted, text


def corpus():
    """Clean texts of common words, some with a look-alike of a term; toxic ones with terms of two words and one stem."""
    r = random.Random(1)
    plain = ["".join(r.choice("aeinorst") for _ in range(r.randrange(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(900):
        words = [r.choice(plain) for _ in range(r.randrange(5, 40))]
        toxic = i % 3 == 0
        if toxic:
            words += [r.choice(["blockhead", "wretched", "vermu" + r.choice(["lo", "ta", "xi", "ne", "kk"])]) for _ in range(3)]
        elif i % 5 == 0:
            words += ["blockheed"]
        r.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def trained(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return docs, labels, tox.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))


def plain_score(model, text):
    """Every word against every term, then the same sums and the same weights."""
    low = text.lower()
    sums, n = {True: {}, False: {}}, 0
    for m in tox.WORD.finditer(low):
        hit = nearest(model["terms"], m.group())
        value = model["weights"][hit[0]][min(hit[1], 2)] if hit else 0
        if hit and value > 0 and not (hit[1] and m.group() in model["known"]):
            n += 1
            side = sums[tox.is_quoted(low, m.start(), m.end())]
            if value > side.get(hit[0], (0, 0))[1]:
                side[hit[0]] = (hit[1], value)
    x = [min(12.0, sum(v for e, v in sums[q].values() if bool(e) == fuzzy)) for q in (False, True) for fuzzy in (False, True)]
    x.append(math.log1p(100 * n / len(tox.words_of(text))) if sums[False] else 0.0)
    return 1 / (1 + math.exp(-(model["w"][0] + float(np.dot(model["w"][1:], x)))))


def test_lexicon_holds_words_and_stems(trained):
    _, _, model = trained
    assert model["terms"] == ["blockhead", "vermu*", "wretched"]
    assert "blockheed" in model["known"]


def test_scores_equal_the_slow_ones_and_find_held_out_texts(spark, trained):
    docs, labels, model = trained
    got = {r.id: r for r in tox.score_documents(docs, model).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got.keys() == texts.keys()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert r.score == pytest.approx(plain_score(model, texts[i]), rel=1e-9) and r.predicted == int(r.score >= 0.5)
    held = [(got[i].predicted, y) for i, y in labels if got[i].held_out]
    assert len(held) > 100 and all(p == y for p, y in held)


def test_misspelt_forms_quotes_and_clean_look_alikes(spark, trained):
    _, _, model = trained
    score = tox.make_scorer(model)
    base = "on a rest iron "
    assert score(base + "blokchead wretchde vermuzz") > 0.5 > score(base + "blockheed") == score(base)
    assert score(base + "you wretched blockhead") > 0.5
    assert score(base + 'they wrote "you wretched blockhead" yesterday') < score(base + "they wrote you wretched blockhead yesterday")


def test_odd_rows(spark, trained):
    _, _, model = trained
    long = "rest iron " * 200_000 + "wretched blockhead vermuta"
    rows = [(None, "wretched blockhead"), (1, None), (1, ""), (2, "wretched blockhead"), (2, "wretched blockhead"), (3, long), (4, "\x00 ퟿ . ,")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit("x").alias("id"), F.lit(1).alias("t"), F.lit(2).alias("y"), F.lit(0).alias("score"))
    got = sorted(((r.id, r.held_out, round(r.score, 9), r.predicted) for r in tox.score_documents(df, model).collect()), key=str)
    low, high = round(tox.make_scorer(model)(""), 9), round(tox.make_scorer(model)("wretched blockhead"), 9)
    assert sorted(s for i, _, s, _ in got if i != 3) == sorted([low] * 3 + [high] * 3)
    assert [p for i, _, _, p in got if i == 3] == [1] and [h for i, h, _, _ in got if i is None] == [False]
    assert tox.score_documents(df.limit(0), model).collect() == []


def test_training_without_enough_labels(spark, trained):
    docs, labels, _ = trained
    one = spark.createDataFrame([(i, 1) for i, y in labels if y] + [(None, 0), (5, None), (7, 3)], "doc_id long, toxic int")
    for some in (one, one.limit(0)):
        model = tox.train(docs, some, seeds=["blockhead", "wretch*"])
        score = tox.make_scorer(model)
        assert model["terms"] == ["blockhead", "wretch*"] and score("a blockhead and a wretch") > 0.5 > score("a rest")
    assert tox.train(docs.limit(0), one)["terms"] == []


def test_held_out_labels_of_the_table(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    found = tox.score_documents(docs, tox.train(docs, labels))
    rows = found.join(labels, F.col("id") == F.col("doc_id")).filter("held_out").select("predicted", "toxic").collect()
    assert found.count() == docs.count() and sum(r.toxic for r in rows) >= 5
    assert sum(r.predicted for r in rows if r.toxic) >= 0.5 * sum(r.toxic for r in rows)
    assert not any(r.predicted for r in rows if not r.toxic)
