"""Packing, exact search and URL verdicts against plain versions."""

import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zoneflow.llm import packing, topk, url_filter
from zoneflow.llm.oracles import ORACLES

WORDS = public_tokenizers.path("word_bpe_49k.json")


def check_pieces(pieces, ids_of, room=4096):
    """Every id once, in place, and no sequence padded."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == ids_of.keys()
    for i, own in by_doc.items():
        own.sort(key=lambda p: p.start)
        assert [p.start for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        assert sum(p.length for p in own) == len(ids_of[i]) == own[0].doc_tokens
        for p in own:
            assert zlib.crc32(np.array(ids_of[i][p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        n = sum(p.length for p in own)
        assert 0 < n <= room and n & (n - 1) == 0


def test_pack_a_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    tok = Tokenizer.from_file(WORDS)
    ids = {r.doc_id: [*tok.encode(r.text or "", add_special_tokens=False).ids, 2] for r in docs.collect()}
    for size in (packing.GROUP_BYTES, 60_000):
        check_pieces(packing.piece_digests(packing.pack_documents(docs, WORDS, group_bytes=size)).collect(), ids)


def test_pack_odd_rows(spark):
    df = spark.createDataFrame([(None, None, 1), (1, "", 2), (2, "a " * 30_000, 3), (3, "<|endoftext|> x", 4)], "doc_id long, text string, g int")
    ids = {None: [2], 1: [2], 2: [320] * 30_000 + [2], 3: Tokenizer.from_file(WORDS).encode("<|endoftext|> x", add_special_tokens=False).ids + [2]}
    check_pieces(packing.piece_digests(packing.pack_documents(df, WORDS)).collect(), ids)
    same = spark.createDataFrame([(1, "b")] * 5, "doc_id long, text string")
    rows = packing.pack_documents(same, WORDS).collect()
    assert sum(r.length for r in rows) == 10 and {r.doc_tokens for r in rows} == {2}
    assert packing.pack_documents(df.limit(0), WORDS).collect() == []


def test_first_fit_decreasing():
    r = random.Random(4)
    for _ in range(50):
        room, sizes = 100, [r.randint(1, 100) for _ in range(r.randint(0, 60))]
        left, want = [], []
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            b = next((b for b, free in enumerate(left) if free >= sizes[i]), len(left))
            if b == len(left):
                left.append(room)
                want.append([])
            left[b] -= sizes[i]
            want[b].append(i)
        assert packing.first_fit_decreasing(sizes, room) == want


def test_pack_group_of_other_rooms():
    r = random.Random(6)
    for room in (1, 8, 4096):
        lengths = [r.randint(1, 3 * room) for _ in range(200)]
        bins = packing.pack_group(lengths, room)
        cells = sorted((d, s + i) for b in bins for d, s, n in b for i in range(n))
        assert cells == [(d, i) for d, n in enumerate(lengths) for i in range(n)]
        assert all(n & (n - 1) == 0 and n <= room for n in (sum(p[2] for p in b) for b in bins))


def plain_top(rows, k):
    """{query: [(id, score)]} over (id, vector) rows"""
    fine = lambda v: v is not None and all(x is not None and np.isfinite(x) for x in v)
    rows = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if i is not None and fine(v)]
    out = {}
    for q, a in rows:
        if q % 100 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def top_of(df, k=10):
    out = {}
    for r in topk.top_k(df, F.col("vec_id") % 100 == 0, k=k).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("k", [1, 10])
def test_top_k_of_copies_ties_and_odd_vectors(spark, k, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 150)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    r = random.Random(8)
    vector = lambda: [r.uniform(-1, 1) for _ in range(7)]
    hot, few = vector(), [vector() for _ in range(30)]
    rows = [(i, r.choice([hot, r.choice(few), vector(), [0.0] * 7])) for i in range(1200)]
    rows += [(1300, None), (1400, [None] * 7), (1500, [float("nan")] * 7), (1601, [float("inf")] * 7), (None, hot), (1700, []), (1800, [1.0])]
    rows += [(1900, [70000.0] * 7), (1901, [-70000.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert top_of(df, k) == plain_top(rows, k)


def test_top_k_of_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (100, [0.5, 0.5]), (101, [2.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert top_of(df) == plain_top(rows, 10)
    assert top_of(df.limit(0)) == {} == top_of(df.filter("vec_id = 101"))
    assert top_of(df.filter("vec_id = 100")) == {}


def test_top_k_of_large_components(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    r = random.Random(9)
    # 1e5: squares fit a long; 1e9 and 1e30 meet only vectors that keep their scores small; the last ones differ beyond 65,536
    rows = [(i, [r.uniform(-1, 1) * r.choice([1, 1e5]) for _ in range(64)]) for i in range(700)]
    rows += [(800, [100000.0] * 64), (801, [100000.0] * 64), (802, [70000.0] * 64), (803, [80000.0] * 64), (804, [80000.0] * 63)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    for k in (1, 10):
        got = top_of(df, k)
        assert got == plain_top(rows, k)
    assert got[800][:1] == [(801, 64 * 102_400_000**2)]


def test_top_k_of_copies_and_odd_vectors_beside_long_ones(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 150)
    r = random.Random(8)
    vector = lambda: [r.uniform(-1, 1) for _ in range(7)]
    hot, few = vector(), [vector() for _ in range(30)]
    far = [[1e5 * x for x in v] for v in few[:3]]
    rows = [(i, r.choice([hot, r.choice(few), vector(), [0.0] * 7, r.choice(far)])) for i in range(600)]
    rows += [(1300, None), (1400, [None] * 7), (1500, [float("nan")] * 7), (1601, [float("inf")] * 7), (None, hot), (1700, []), (1800, [1.0])]
    rows += [(1900, [3e5] * 7), (1901, [-70000.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert top_of(df) == plain_top(rows, 10)


def test_top_k_of_scores_around_the_end_of_longs(spark):
    big = 2.0**100
    rows = [(0, [big, big, 0.0]), (1, [big, -big, 1.0]), (2, [0.0, 0.0, 5.0]), (3, [-1.0, 1.0, 0.0]), (100, [0.0, 0.0, -2.0]), (101, [0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [(i, v + [0.0] * (3 - len(v))) for i, v in rows]
    assert top_of(df) == plain_top(whole, 10)  # sums beyond 64 bits that cancel
    edge = [(0, [2.0**30, -(2.0**30)]), (1, [-(2.0**13), 0.0]), (2, [2.0**13 - 2.0**-10, 0.0])]  # -2^63 is a long, and 2^63 - 2^40
    edge_df = spark.createDataFrame(edge, "vec_id long, embedding array<double>")
    assert top_of(edge_df) == plain_top(edge, 10) == {0: [(2, 2**63 - 2**40), (1, -(2**63))]}
    for other in ([2.0**13, 0.0], [0.0, 2.0**13 + 1]):  # 2^63 and below -2^63
        with pytest.raises(Exception, match="does not fit a long"):
            top_of(edge_df.filter("vec_id = 0").unionAll(spark.createDataFrame([(5, other)], edge_df.schema)))
    # of no answer: the vector's own score, and low ones behind k others
    assert top_of(edge_df.filter("vec_id <> 1").unionAll(spark.createDataFrame([(5, [-(2.0**40), 0.0])], edge_df.schema)), 1) == {0: [(2, 2**63 - 2**40)]}
    with pytest.raises(Exception, match="does not fit a double"):
        top_of(spark.createDataFrame([(0, [1e307]), (1, [1.0])], edge_df.schema))


@pytest.mark.parametrize("size", [1.0, 1e6, 1e200])
def test_pairs_left_out_are_proven(size):
    r = np.random.default_rng(3)
    a = np.floor(r.standard_normal((20, 9)) * size * 1000)
    c = np.floor(r.standard_normal((300, 9)) * size * r.choice([1.0, 1e-3, 1e50], (300, 1)))
    c[:40] = c[40:80] + np.spacing(c[40:80]) * r.integers(-1, 2, (40, 9))
    c = np.floor(c)
    exact = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in c] for p in a]
    i, j = topk.may_lead(a, c, 11)
    assert topk.whole_scores(a, c, i, j).tolist() == [exact[x][y] for x, y in zip(i, j)]
    for x in range(len(a)):
        bound = sorted(exact[x])[-11]
        assert set(j[i == x]) >= {y for y in range(len(c)) if exact[x][y] >= bound}


RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def page(i, url, html=None):
    return (i, url, html, "x")


def canonical(url):
    return f"<html><head><LINK href='{url}' REL=\"canonical\"></head>"


def refresh(url):
    return f'<meta http-equiv="Refresh" content="0; URL={url}">'


def verdicts(spark, rows, **more):
    df = spark.createDataFrame(rows, "page_id int, url string, html string, verdict string")
    return {r.id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df, RULES, **more).collect()}


def test_rules(spark):
    got = verdicts(
        spark,
        [
            page(1, "HTTP://WWW.Example.COM/en/x?q=/a#b"), page(2, "https://a.example.com/en/"), page(3, "http://example.com/EN/"),
            page(4, "http://example.com"), page(5, "http://b.net/fr/#x"), page(6, "http://notexample.com/en/"), page(7, None), page(8, "no scheme"),
            page(9, "x://net/es/1?://com/"), page(10, "://com/"), page(11, "http://net?/es/"), page(12, "http://É.net/fr/É"), page(13, "a\nb://com/\nx"),
        ],
    )
    assert got == {
        1: ("www.example.com", "/en/x", "www.example.com/en/", "allow"), 2: ("a.example.com", "/en/", "example.com/en/", "block"),
        3: ("example.com", "/EN/", "com/", "allow"), 4: ("example.com", "", None, "allow"), 5: ("b.net", "/fr/", "net/fr/", "block"),
        6: ("notexample.com", "/en/", "com/", "allow"), 7: ("", "", None, "allow"), 8: ("", "", None, "allow"),
        9: ("net", "/es/1", "net/es/", "block"), 10: ("com", "/", "com/", "allow"), 11: ("net", "", None, "allow"),
        12: ("É.net", "/fr/É", "net/fr/", "block"), 13: ("com", "/\nx", "com/", "allow"),
    }


def test_aliases(spark):
    rows = [
        # chain to a blocked page
        page(1, "http://a.org/1", canonical("http://b.org/2?x=1")), page(2, "http://b.org/2", refresh("https://c.net/fr/3")), page(3, "http://c.net/fr/3"),
        # an allowed alias takes precedence
        page(4, "http://d.org/", canonical("http://e.net/es/")), page(5, "http://d.org/#z", refresh("http://www.example.com/en/ok")),
        # the blocked page itself stays blocked, the target need not be a page
        page(6, "http://e.net/es/"), page(7, "http://f.org/x/y", canonical("../no")), page(8, "http://g.net/q", canonical("/fr/rel")),
        page(9, "http://h.org/", canonical("http://h.org/")), page(10, None, canonical("http://c.net/fr/3")), page(11, "http://i.org/"),
        page(12, "http://k.net/z", refresh("//l.net/es/q")),
    ]
    got = {i: v[3] for i, v in verdicts(spark, rows).items()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "block", 7: "allow", 8: "block", 9: "allow", 10: "allow", 11: "allow", 12: "block"}
    more = spark.createDataFrame([("http://i.org/?a", "http://a.org/1"), (None, "http://h.org/")], "a string, b string")
    assert verdicts(spark, rows, redirects=more)[11][3] == "block"


def test_no_pages_and_no_rules(spark):
    assert verdicts(spark, []) == {}
    df = spark.createDataFrame([page(1, "http://a.com/"), page(1, "http://a.com/")], "page_id int, url string, html string, verdict string")
    assert [tuple(r) for r in url_filter.judge_urls(df, []).collect()] == [(1, "a.com", "/", None, "allow")] * 2
    with pytest.raises(ValueError):
        url_filter.judge_urls(df, RULES * 1000)


def test_rules_as_a_long_table(spark):
    r = random.Random(5)
    hosts = ["com", "a.com", "b.a.com", "net", "x.net", "É.net", ""]
    paths = ["/", "/a", "/a/", "/a/b", "/é", "", "/a/b/c"]
    short = [(r.choice(hosts), r.choice(paths), r.choice(["allow", "block"])) for _ in range(25)]
    hosts_seen = ["a.com", "www.b.a.com", "xcom", "com.", "y.x.net", "É.net", "org"]
    rows = [page(i, f"http://{r.choice(hosts_seen)}{r.choice(paths)}{r.choice(['', 'q', '?x'])}") for i in range(150)] + [page(900, None)]
    rows += [page(901, "http://org/1", canonical("http://no7.test/p/x")), page(902, "http://no2999.test/p"), page(902, "http://z.no2999.test/p/1")]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, verdict string")
    table = lambda rules: spark.createDataFrame(rules, "host string, path string, verdict string")
    got = lambda rules, df: sorted(map(str, url_filter.judge_urls(df, rules).collect()))
    assert got(table(short), df) == got(short, df)
    long = [(f"no{i}.test", "/p", "block") for i in range(3000)] + [(None, "/", "block")]
    found = {r.id: (r.rule, r.verdict) for r in url_filter.judge_urls(df.filter("page_id > 900"), table(long)).collect()}
    assert found == {901: (None, "block"), 902: ("no2999.test/p", "block")}
    assert {r.verdict for r in url_filter.judge_urls(df, table([])).collect()} == {"allow"}


def test_first_link_of_each_kind_counts_as_in_the_sql(spark):
    free, shut = "http://org/free", "http://c.net/fr/3"
    rows = [
        page(1, "http://a.org/1", canonical(free) + canonical(shut)), page(2, "http://a.org/2", canonical(shut) + canonical(free)),
        page(3, "http://a.org/3", refresh(free) + refresh(shut)), page(4, "http://a.org/4", refresh("http://org/other") + canonical(shut)),
    ]
    got = {i: v[3] for i, v in verdicts(spark, rows).items()}
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id INT, url VARCHAR, html VARCHAR, verdict VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?, ?)", rows)
    sql = {r[0]: r[1] for r in con.execute(f"SELECT page_id, verdict FROM ({ORACLES['op6_url_filter']})").fetchall()}
    assert got == sql == {1: "allow", 2: "block", 3: "allow", 4: "block"}
