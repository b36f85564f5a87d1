"""Exact and near copies and repeated strings against plain versions, and graph components."""

import random

import pytest
from conftest import SF_SMALL
from plain import Classes, cut_out, exact_groups, near_classes, repeat_spans

from zoneflow.llm import exact_dedup, near_dedup, suffix_dedup
from zoneflow.llm.graph import components

WORDS = [f"w{i}" for i in range(400)]


def table(spark, texts, parts=4):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(parts)


def edited(r, words, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = r.choice(WORDS)
    return words


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies in a chain and in one large group, shared passages, repeats inside, odd texts."""
    r = random.Random(5)
    make = lambda n: [r.choice(WORDS) for _ in range(n)]
    texts = [" ".join(make(r.randint(1, 150))) for _ in range(150)]
    texts += [None, None, "", " ", "\n\t", "A", "a", "a b", "A  b", "a b c", "ß é 日本語", "ß é  日本語"]
    base, passage, chain = make(120), " ".join(make(60)), make(100)
    texts += [" ".join(edited(r, base, r.randint(0, 12))) for _ in range(160)]
    for _ in range(12):
        chain = edited(r, chain, 2)
        texts.append(" ".join(chain))
    texts += [f"{' '.join(make(20))} {passage} {' '.join(make(20))}" for _ in range(8)]
    texts += [" ".join(make(2)) + " " + "la " * 200, "é" * 300, "xé" + "é" * 99, " ".join(make(80)) * 2, "x" * 199, "x" * 200, "y" * 201]
    texts += r.choices(texts, k=40) + [texts[0]] * 30 + [texts[0].replace(" ", "  \t")] * 3
    ids = r.sample(range(10_000), len(texts))
    return dict(zip(ids, texts))


def test_exact_groups(spark, corpus):
    got = {r.id: (r.keep_id, r.group_size, r.text_sha256, r.kept) for r in exact_dedup.exact_groups(table(spark, corpus)).collect()}
    assert got == {i: (k, n, d, i == k) for i, (k, n, d) in exact_groups(corpus).items()}


def test_exact_groups_of_odd_rows(spark):
    rows = [(None, "x", 1), (None, "x", 2), (7, "x", 3), (7, "x", 4), (9, None, 5), (8, "", 6), (None, "y", 7), (None, "y", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = exact_dedup.exact_groups(df).collect()
    assert sorted((r.keep_id or 0, r.group_size) for r in got) == [(0, 2)] * 2 + [(7, 4)] * 4 + [(8, 2)] * 2
    assert sorted((r.id or 0, r.keep_id or 0) for r in got if r.kept) == [(0, 0), (7, 7), (8, 8)]
    stay = exact_dedup.drop_exact_copies(df)
    assert stay.columns == ["doc_id", "text", "fp"]
    assert sorted((r.doc_id or 0, r.text) for r in stay.collect()) == [(0, "y"), (7, "x"), (8, "")]
    assert exact_dedup.exact_groups(df.limit(0)).collect() == [] == exact_dedup.drop_exact_copies(df.limit(0)).collect()


def test_exact_drop(spark, corpus):
    kept = exact_dedup.drop_exact_copies(table(spark, corpus))
    assert {r.doc_id for r in kept.collect()} == {k for k, _, _ in exact_groups(corpus).values()}


def test_bloom_filter_never_misses(spark):
    ids = spark.range(0, 3000).selectExpr("sha2(cast(id % 2500 as string), 256) as fp")
    prints = ids.selectExpr("monotonically_increasing_id() as row_no", "1L as id", "unhex(fp) as fp").cache()
    maybe, single = exact_dedup.split_by_filter(prints)
    assert maybe.count() + single.count() == 3000
    assert single.join(prints.groupBy("fp").count().filter("count > 1"), "fp").count() == 0
    assert maybe.count() < 1300


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80), (1, 60)])
def test_near_classes(spark, corpus, k, percent):
    found = near_dedup.near_duplicates(table(spark, corpus), shingle=k, percent=percent).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in found} == near_classes(corpus, k, percent)
    assert all(r.kept == (r.id == r.component_id) for r in found)


def test_near_classes_in_small_blocks(spark, corpus, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_DOCS", 16)
    got = near_dedup.near_duplicates(table(spark, corpus), shingle=3, percent=85).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == near_classes(corpus, 3, 85)


def test_near_classes_of_a_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = near_classes({r.doc_id: r.text for r in docs.collect()}, 3, 85)
    assert {r.id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs, shingle=3, percent=85).collect()} == want


def test_near_threshold_has_a_lower_bound(spark, corpus):
    assert [near_dedup.hashes_per_collection(p) for p in (100, 85, 80, 75, 60)] == [3, 3, 3, 2, 1]
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(table(spark, corpus), percent=40)


def test_near_drop(spark, corpus):
    kept = near_dedup.drop_near_copies(table(spark, corpus).withColumnRenamed("text", "node"), text_col="node")
    assert kept.columns == ["doc_id", "node"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in near_classes(corpus, 5, 80).values()})


def test_near_odd_rows(spark):
    long = " ".join(WORDS[:50])
    rows = [(None, long, 1), (None, long, 2), (3, None, 3), (4, "", 4), (4, "", 4), (5, long, 5), (5, long, 5), (6, long + " x", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = near_dedup.near_duplicates(df).collect()
    assert sorted((r.id or 0, r.n_shingles, r.component_id) for r in got) == [
        (0, 46, 5), (0, 46, 5), (3, 0, 3), (4, 0, 4), (4, 0, 4), (5, 46, 5), (5, 46, 5), (6, 47, 5),
    ]
    assert sum(r.kept for r in got) == 4
    assert sorted(r.doc_id for r in near_dedup.drop_near_copies(df).collect()) == [3, 4, 4, 5]
    assert near_dedup.near_duplicates(df.limit(0)).collect() == []


def test_repeats(spark, corpus, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 9_000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_RANKS", 700)
    for window in (200, 150):
        got = {r.id: r for r in suffix_dedup.repeat_spans(table(spark, corpus), window=window).collect()}
        want = repeat_spans(corpus, window)
        for i, t in corpus.items():
            raw = (t or "").encode()
            assert [tuple(s) for s in got[i].spans] == want[i], (window, i)
            assert bytes(got[i].kept) == cut_out(raw, want[i])
            assert (got[i].n_bytes, got[i].n_removed) == (len(raw), sum(b - a for a, b in want[i]))


def test_repeats_with_partners_inside_longer_ones(spark):
    """A short repeat whose partner lies inside a long one has nothing open on the partner's side."""
    r = random.Random(3)
    letters = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    long = letters(1500)
    texts = {0: letters(50) + long + letters(50), 1: letters(31) + long}
    for i in range(2, 40):
        at, n = r.randrange(0, 1200), r.randint(195, 300)
        texts[i] = letters(r.randint(0, 90)) + long[at : at + n] + letters(r.randint(0, 90))
    want = repeat_spans(texts, 200)
    got = suffix_dedup.repeat_spans(table(spark, texts)).collect()
    assert {r.id: [tuple(s) for s in r.spans] for r in got} == want


def test_repeat_drop(spark, corpus):
    df = table(spark, corpus).selectExpr("doc_id", "text", "length(text) as n_chars", "1 as part", "'é' as t")
    got = {r.doc_id: r for r in suffix_dedup.drop_repeats(df, chars_col="n_chars").collect()}
    for i, spans in repeat_spans(corpus, 200).items():
        t = corpus[i]
        if t is None:
            assert got[i].text is None and got[i].n_chars is None
            continue
        # a character stays unless all its bytes are covered
        at, kept = 0, []
        for c in t:
            n = len(c.encode())
            if not any(a <= at and at + n <= b for a, b in spans):
                kept.append(c)
            at += n
        assert got[i].text == "".join(kept) and got[i].n_chars == len(kept) and got[i].t == "é"


def test_repeats_of_odd_rows(spark):
    t = "0123456789" * 21
    df = spark.createDataFrame([(None, None), (1, ""), (1, ""), (None, t), (2, "a")], "doc_id long, text string")
    got = sorted((r.id or 0, r.n_bytes, r.n_removed) for r in suffix_dedup.repeat_spans(df).collect())
    assert got == [(0, 0, 0), (0, 210, 210), (1, 0, 0), (1, 0, 0), (2, 1, 0)]
    assert suffix_dedup.repeat_spans(df.limit(0)).collect() == []
    assert suffix_dedup.drop_repeats(df.limit(0)).collect() == []


def test_cover_reaches_every_shift():
    for q in (2, 3, 5, 7, 8):
        v, cover = suffix_dedup.difference_cover(q)
        assert {(a - b) % v for a in cover for b in cover} == set(range(v)) and len(cover) == q + 1


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, i) for i in range(400, 480)]
    edges += [(r.randrange(1000, 1300), r.randrange(1000, 1300)) for _ in range(150)] + [(7, 7), (2000, 2000), (None, 3), (5, 6), (6, 5)]
    want = Classes({x for e in edges for x in e if x is not None and None not in e})
    for a, b in edges:
        if a is not None:
            want.join(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {x.node: x.component for x in got} == {x: want.find(x) for x in want.up} and len(got) == len(want.up)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def thue_morse(n, letters="ab"):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def test_near_copies_of_texts_that_fool_rolling_hashes(spark):
    """A Thue-Morse word and its complement agree under every polynomial hash modulo a power of two."""
    texts = {1: f"one two {thue_morse(1024)}", 2: f"one two {thue_morse(1024, 'ba')}", 3: f"{thue_morse(2048)} {thue_morse(2048, 'ba')} end"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df, shingle=3, percent=85).collect()}
    assert got == {i: (1, i) for i in texts}


def test_repeats_of_texts_that_fool_rolling_hashes(spark):
    texts = {1: "x" * 80 + thue_morse(1024), 2: "y" * 80 + thue_morse(1024, "ba")}
    texts |= {3: thue_morse(4096, "cd"), 4: thue_morse(4096, "dc")}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.id: [tuple(s) for s in r.spans] for r in suffix_dedup.repeat_spans(df).collect()}
    assert got == repeat_spans(texts, 200)
