"""Token counts and BPE against the libraries, on odd texts and on a whole small table."""

import hashlib
import json
import os
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF_SMALL
from tokenizers import Tokenizer

from zoneflow.llm import bpe, token_counts
from zoneflow.llm.lexicon import Lexicon, compile_lexicon

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "  ", "   ", "a", " a", "a ", "  a  b   c    ", "\n", "a\n b", "a \n b", "a\n\n  b\t c ", "▁a▁▁b", "don't we'll I'M",
    "<|endoftext|>", "x <|endoftext|> y<|startoftext|>", "<s>hi</s><unk>", "日本語 テスト ï ß é ΑΣ Σ.", "͸ unassigned \U0003fc3f",
    "é ﬁ K Å İ", "😀 👩‍👩‍👧 a", "\x00 \x1f \x85 \xa0 x", "a" * 3000, "ab " * 2000, "1234567 12.5%", "  　 z", "\r\n \r\n",
]


def random_texts(n, seed=7):
    r = random.Random(seed)
    parts = ["the", "ing", " ", " ", "  ", "\n", "\t", "é", "ß", "'s", "'", ".", ",", "!!", "12", "ñ", "▁", "日", " ", "A", "Σ", "<|endoftext|>"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(n)]


def rows_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def test_counts_equal_the_library(spark):
    texts = ODD + random_texts(2000)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.id: r for r in token_counts.count_tokens(rows_of(spark, texts), PIECES, limit=10).collect()}
    for i, t in enumerate(texts):
        n = len(sp.encode(t))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(t.encode()), n, n > 10), t


def test_counts_of_a_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = {r.doc_id: len(sp.encode(r.text or "")) for r in docs.collect()}
    assert {r.id: r.n_tokens for r in token_counts.count_tokens(docs, PIECES).collect()} == want


def test_whole_tokens_are_proven():
    with open(PIECES, "rb") as f:
        whole = token_counts.whole_tokens(f.read())
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert len(whole) > 10_000 and "the" in whole
    assert all(len(sp.encode(w.replace("▁", " "))) == 1 for w in whole[1:])


def test_counts_of_odd_tables(spark):
    df = spark.createDataFrame([(None, None, 1), (5, None, 2), (5, "a", 2), (5, "a", 2)], "`doc id` long, text string, n_tokens int")
    rows = token_counts.count_tokens(df, PIECES, id_col="doc id").collect()
    assert sorted((r.id is None, r.n_bytes, r.n_tokens) for r in rows) == [(False, 0, 0), (False, 1, 1), (False, 1, 1), (True, 0, 0)]
    assert token_counts.count_tokens(df.limit(0), PIECES, id_col="doc id").collect() == []


@pytest.mark.parametrize("vocabulary", [BYTES, WORDS])
def test_encoder_equals_the_library(vocabulary, tmp_path):
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    tok = Tokenizer.from_file(vocabulary)
    texts = ODD + random_texts(3000)
    plain = bpe.WordEncoder(spec)
    words = ["the", " the", "ing", "é", "é.", " a"]
    path = tmp_path / "lex"
    path.write_bytes(compile_lexicon((w.encode(), np.frombuffer(i, "<u4").tolist()) for w, i in zip(words, plain._merge(words))))
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert bpe.merges_by_rank(spec)
    for enc in (plain, bpe.WordEncoder(spec, Lexicon(str(path))), bpe.WordEncoder(spec, ranked=True)):
        for t, got, ids in zip(texts, enc.encode(texts), want):
            assert np.frombuffer(got, "<u4").tolist() == ids, repr(t)


def test_merging_by_rank_is_refused_without_proof():
    with open(BYTES, encoding="utf-8") as f:
        spec = json.loads(f.read())
    spec["model"]["merges"][0], spec["model"]["merges"][1] = spec["model"]["merges"][1], spec["model"]["merges"][0]
    assert not bpe.merges_by_rank(json.dumps(spec))


def test_encoder_with_a_tiny_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 5)
    monkeypatch.setattr(bpe, "RUN_CHARS", 50)
    with open(BYTES, encoding="utf-8") as f:
        enc = bpe.WordEncoder(f.read())
    tok = Tokenizer.from_file(BYTES)
    texts = random_texts(300, 3)
    assert [np.frombuffer(i, "<u4").tolist() for i in enc.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_every_character_splits_as_in_the_library():
    """One text per character that Python knows; those it does not know go to the library whole."""
    with open(BYTES, encoding="utf-8") as f:
        enc = bpe.WordEncoder(f.read())
    tok = Tokenizer.from_file(BYTES)
    texts = [f"a{c}1{c}! {c} {c}{c}x" for c in map(chr, [*range(0x3000), *range(0xA000, 0xD7FF, 7), *range(0xE000, 0x1FFFF, 11)])]
    texts = ["\n".join(texts[i : i + 50]) for i in range(0, len(texts), 50)]
    assert [np.frombuffer(i, "<u4").tolist() for i in enc.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_lexicon(tmp_path):
    r = random.Random(1)
    words = {bytes(r.choice(b"abc") for _ in range(r.randint(1, 8))): [r.randrange(2**32) for _ in range(r.randint(0, 4))] for _ in range(3000)}
    path = tmp_path / "lex"
    path.write_bytes(compile_lexicon(words.items()))
    lex = Lexicon(str(path))
    asked = [bytes(r.choice(b"abcd") for _ in range(r.randint(0, 9))) for _ in range(5000)] + list(words)
    for w, got in zip(asked, lex.find(asked)):
        assert (None if got is None else np.frombuffer(got, "<u4").tolist()) == words.get(w), w
    # minimal: one state per distinct set of endings that can follow a prefix
    follow = {}
    for w in words:
        for i in range(len(w) + 1):
            follow.setdefault(w[:i], set()).add(w[i:])
    assert len(lex.final) == len({frozenset(v) for v in follow.values()})
    path.write_bytes(compile_lexicon([]))
    assert Lexicon(str(path)).find([b"a", b""]) == [None, None]


def test_frequent_words_are_not_lost(spark, monkeypatch):
    """Many rare words overflow the counters again and again; a frequent one that comes late stays."""
    monkeypatch.setattr(bpe, "RUN_CHARS", 500)
    r = random.Random(9)
    rare = [f"x{i}y" for i in range(3000)]
    texts = [" ".join(r.choice(rare) + "z" for _ in range(40)) for _ in range(100)]
    texts += [" ".join(r.choice(["late", *rare]) if r.random() > 0.2 else "late" for _ in range(40)) for _ in range(100)]
    with open(BYTES, encoding="utf-8") as f:
        spec = f.read()
    got = bpe.frequent_words(rows_of(spark, texts).coalesce(1), spec, "text", 0.01, 50)
    assert " late" in got and len(got) <= 50


def test_round_trip_of_a_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    with open(BYTES, encoding="utf-8") as f:
        name = bpe.build_lexicon(docs, f.read(), share=1e-4)
    tok = Tokenizer.from_file(BYTES)
    got = {r.id: r for r in bpe.round_trip(docs, BYTES, lexicon=name).collect()}
    for r in docs.collect():
        ids = tok.encode(r.text, add_special_tokens=False).ids
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(tok.decode(ids, skip_special_tokens=False).encode()))
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256, got[r.doc_id].decoded_sha256) == want


def test_round_trip_of_odd_rows(spark):
    df = spark.createDataFrame([(None, None), (1, ""), (1, "x<|endoftext|>"), (1, "x<|endoftext|>")], "doc_id long, text string")
    rows = sorted((r.n_tokens, r.decoded_sha256) for r in bpe.round_trip(df, BYTES).collect())
    empty, text = (hashlib.sha256(t).hexdigest() for t in (b"", b"x<|endoftext|>"))
    assert rows == [(0, empty), (0, empty), (2, text), (2, text)]
    assert bpe.round_trip(df.limit(0), BYTES).collect() == []
    assert [len(r.ids) for r in bpe.encode_documents(df, BYTES).orderBy("id", "ids").collect()] == [0, 0, 8, 8]


def test_decode_broken_bytes():
    with open(BYTES, encoding="utf-8") as f:
        spec = f.read()
    tok, table = Tokenizer.from_file(BYTES), bpe.token_bytes(spec)
    for ids in ([224], [50256, 224, 100], [160, 161, 162, 50, 50256]):
        assert bpe.decode(np.array(ids, "<u4").tobytes(), table) == tok.decode(ids, skip_special_tokens=False)
    assert os.path.exists(BYTES)


def test_words_are_counted_in_all_texts(spark, monkeypatch):
    monkeypatch.setattr(bpe, "COUNTED_CHUNKS", 20)
    monkeypatch.setattr(bpe, "RUN_CHARS", 500)
    once = [f"once{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(50)]
    with open(BYTES, encoding="utf-8") as f:
        spec = f.read()
    got = bpe.frequent_words(rows_of(spark, ["the the", *once, None] + ["the"] * 25_000), spec, "text", 1e-5, 60)
    assert got[0] == "the" and set(once) <= set(got)


def test_plain_words_need_no_pattern():
    """Chunks of letters, with or without a full stop or comma, are told without the pattern, and as the pattern would."""

    class Counted:
        def __init__(self, pattern):
            self.pattern, self.asked = pattern, []

        def findall(self, chunk):
            self.asked.append(chunk)
            return self.pattern.findall(chunk)

    with open(BYTES, encoding="utf-8") as f:
        enc = bpe.WordEncoder(f.read())
    pattern, tok = enc.split, Tokenizer.from_file(BYTES)
    odd = ["a.b", "(word", "it's", "'s", "x..", ".", ",", "", " ", " .", "\nword", "\x00a", "ab1", "é,", "中文.", "a\u0301.", "²", "a\u00a0b", "..."]
    for chunk in [*odd, *(" " + c for c in odd if c.strip())]:
        assert list(enc.words(chunk)) == pattern.findall(chunk), chunk
    enc.split = Counted(pattern)
    texts = ["Plain words, and a stop. Größe, 中文 here", "one\x00two three", "tab \tand", "new\nline", "two  blanks", "\x1f x"]
    for text in texts:
        assert np.frombuffer(enc.encode([text])[0], "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
        assert text != texts[0] or enc.split.asked == []
