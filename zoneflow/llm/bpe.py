"""BPE encoding and decoding with a memory-mapped lexicon of frequent words."""

from __future__ import annotations

import hashlib
import json
import os
import re
import tempfile
import unicodedata
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.llm.common import cell, latest_per_process, map_batches, materialise, text_or_empty
from zoneflow.llm.lexicon import Lexicon, compile_lexicon

# Encoded chunks kept per worker process (twice, while a full table is still looked up), and the longest one kept.
CACHE_ENTRIES, CACHE_LENGTH = 350_000, 48
# Texts are worked on in runs of about this many characters, so memory does not follow the batch size.
RUN_CHARS = 1_000_000
# Distinct chunks that a task counts before it hands on what it has.
COUNTED_CHUNKS = 150_000

# Fixed value: how a byte-level vocabulary splits text.
_BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NEAR_BLANK = re.compile(r"\s | \s")
_ASCII_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"
_BEYOND = re.compile("[^\x00-՗]")


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


class _Remembered(dict):
    """Ids per chunk, made at first sight; the table before this one is asked first."""

    def __init__(self, make: Callable[[str], bytes], older: dict[str, bytes]):
        super().__init__()
        self.make, self.older = make, older

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.make(chunk)
        if len(chunk) <= CACHE_LENGTH:
            self[chunk] = ids
        return ids


class WordEncoder:
    """Ids of whole texts, word by word, equal to the library's.

    The two supported layouts are recognised from the vocabulary file: byte-level splitting without a
    normaliser, and splitting that drops white space after composing and lower-casing. A text is cut at
    single blanks into chunks; no word of either layout reaches across one, so chunks can be encoded one by
    one and remembered. Chunks are split into words, words are looked up in the lexicon, and what it lacks
    is merged by the library.

    Texts that hold a special string go to the library whole, as do texts with characters that this Python
    does not know yet (its tables and the library's may differ there) and, when lower-casing, capital sigma,
    whose lower case depends on its neighbours.
    """

    def __init__(self, spec: str, lexicon: Lexicon | None = None, ranked: bool = False):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        parsed = json.loads(spec)
        self.whole = Tokenizer.from_str(spec)
        self.whole.no_padding()
        self.whole.no_truncation()
        self.special = [t["content"] for t in parsed["added_tokens"]]
        self.lexicon, self.cache, self.older = lexicon, {}, {}
        self.by_rank = _rank_merger(parsed) if ranked else None
        self.end = " " if parsed["model"].get("end_of_word_suffix") else ""
        self.seen = _Remembered(self._encode_chunk, {})
        self.merger = Tokenizer(self.whole.model)
        self.merger.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        pre, norm = parsed["pre_tokenizer"], parsed["normalizer"]
        self.lower = False
        if norm is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            self.split = regex.compile(_BYTE_LEVEL_SPLIT)
        elif self._drops_blanks(pre, norm):
            self.split = regex.compile(pre["pretokenizers"][0]["pattern"]["Regex"])
            self.lower = True
        else:
            raise ValueError("this vocabulary's way of splitting text is not supported")

    @staticmethod
    def _drops_blanks(pre: dict, norm: dict | None) -> bool:
        steps = [n["type"] for n in (norm or {}).get("normalizers", [])]
        parts = pre.get("pretokenizers", [])
        return (
            steps == ["NFC", "Replace", "Lowercase"]
            and [p["type"] for p in parts] == ["Split", "ByteLevel"]
            and parts[0]["behavior"] == "Removed"
            and parts[0]["invert"]
            and not parts[1]["use_regex"]
            and not parts[1]["add_prefix_space"]
        )

    def chunks(self, text: str) -> list[str] | None:
        """Parts of the text that can be encoded one by one; None when it must be encoded whole."""
        if any(s in text for s in self.special):
            return None
        if self.lower and "Σ" in text:
            return None
        if not text.isascii() and _BEYOND.search(text) and any(unicodedata.category(c) == "Cn" for c in set(text)):
            return None
        if self.lower:
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
            return text.lower().split(" ")
        if _blank_beside_space(text):  # is split by what surrounds it
            return self.split.findall(text)
        if "\0" not in text:
            return text.replace(" ", "\0 ").split("\0")
        first, *rest = text.split(" ")
        return [first, *(" " + c for c in rest)]

    def words(self, chunk: str) -> Sequence[str]:
        """Words of one chunk; most are letters, with or without a full stop or comma behind them."""
        bare = chunk if self.lower else chunk.removeprefix(" ")
        if bare.isalpha():
            return (chunk,)
        if bare[-1:] in (".", ",") and bare[:-1].isalpha():
            return chunk[:-1], chunk[-1]
        return self.split.findall(chunk)

    def _merge(self, words: list[str]) -> list[bytes]:
        if self.by_rank:
            return [array("I", self.by_rank(w + self.end)).tobytes() for w in words]
        got = self.merger.encode_batch_fast(words, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in got]

    def _encode_chunks(self, fresh: list[str]) -> dict[str, bytes]:
        parts = [self.words(c) for c in fresh]
        words = list({w for p in parts for w in p})
        found = self.lexicon.find([w.encode() for w in words]) if self.lexicon else [None] * len(words)
        table = dict(zip(words, found))
        unseen = [w for w in words if table[w] is None]
        for i in range(0, len(unseen), 20_000):
            table.update(zip(unseen[i : i + 20_000], self._merge(unseen[i : i + 20_000])))
        return {c: table[p[0]] if len(p) == 1 else b"".join([table[w] for w in p]) for c, p in zip(fresh, parts)}

    def _encode_chunk(self, chunk: str) -> bytes:
        """One chunk by rank; most are letters, with or without a full stop or comma behind them."""
        if chunk.isalpha():
            return array("I", self.by_rank(chunk + self.end)).tobytes()
        if self.lower and chunk[-1:] in (".", ",") and chunk[:-1].isalpha():
            return array("I", [*self.by_rank(chunk[:-1] + self.end), *self.by_rank(chunk[-1] + self.end)]).tobytes()
        return b"".join(self._merge(self.split.findall(chunk)))

    def _encode_alone(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if self.by_rank and not self.lexicon:  # merging a word is cheap: no need to gather words first
            out = []
            for text in texts:
                parts = self.chunks(text)
                out.append(self._encode_alone(text) if parts is None else b"".join(map(self.seen.__getitem__, parts)))
                if len(self.seen) > CACHE_ENTRIES:
                    self.seen = _Remembered(self._encode_chunk, dict(self.seen))
            return out
        out = []
        for run in _runs(texts):
            cut = [self.chunks(t) for t in run]
            # a dict is asked for each chunk, while a view of its keys would be gone through as a whole
            fresh = set().union(*(c for c in cut if c is not None)).difference(self.cache)
            unseen = fresh.difference(self.older)
            made = {c: self.older[c] for c in fresh - unseen}
            made |= self._encode_chunks(list(unseen))
            long = [c for c in made if len(c) > CACHE_LENGTH]
            self.cache |= made
            for text, parts in zip(run, cut):
                if parts is None:
                    out.append(self._encode_alone(text))
                else:
                    out.append(b"".join(map(self.cache.__getitem__, parts)))
            for c in long:
                del self.cache[c]
            if len(self.cache) > CACHE_ENTRIES:
                self.older, self.cache = self.cache, {}
        return out


def merges_by_rank(spec: str) -> bool:
    """Offline proof that merging by id gives the same ids as merging by the vocabulary's list.

    True when every merge makes the next id, all bytes have an id (alone and, where words have an end mark, with
    it, below those of the merges), and every string that is a whole word encodes to its own id alone; a
    faster merger may then take the place of the list's.
    """
    parsed = json.loads(spec)
    vocab, suffix = parsed["model"]["vocab"], parsed["model"].get("end_of_word_suffix") or ""
    pairs = [m if isinstance(m, list) else m.split(" ") for m in parsed["model"]["merges"]]
    joined = [a + b for a, b in pairs]
    first = min((vocab.get(j, -1) for j in joined), default=-1)
    back = {c: b for b, c in byte_alphabet().items()}
    singles = [vocab.get(c + end, first) for c in back for end in {"", suffix}]
    if [vocab.get(j) for j in joined] != list(range(first, first + len(joined))) or max(singles) >= first:
        return False
    texts = [(vocab[j], bytes(back[c] for c in j.removesuffix(suffix))) for j in joined if j.endswith(suffix)]
    whole = [(i, raw.decode()) for i, raw in texts if _is_text(raw)]
    got = WordEncoder(spec)._merge([t for _, t in whole])
    return all(np.frombuffer(g, "<u4").tolist() == [i] for (i, _), g in zip(whole, got))


def _is_text(raw: bytes) -> bool:
    try:
        raw.decode()
    except UnicodeDecodeError:
        return False
    return True


def _rank_merger(parsed: dict):
    """Merger by rank. A word's end mark is written as a blank, which no word of such a vocabulary holds; the last
    byte and its mark merge before anything else, because their ids are the lowest."""
    import tiktoken

    back, suffix = {c: b for b, c in byte_alphabet().items()}, parsed["model"].get("end_of_word_suffix") or ""
    special = {t["content"] for t in parsed["added_tokens"]}
    ranks = {}
    for s, i in parsed["model"]["vocab"].items():
        ended = bool(suffix) and s.endswith(suffix)
        name = s.removesuffix(suffix) if ended else s
        if s not in special and all(c in back for c in name):
            ranks[bytes(back[c] for c in name) + (b" " if ended else b"")] = i
    piece = tiktoken.Encoding("own", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})._encode_single_piece
    return lambda word: piece(word.encode())


def _runs(texts: Iterable[str]) -> Iterator[list[str]]:
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= RUN_CHARS:
            yield run
            run, size = [], 0
    if run:
        yield run


def _blank_beside_space(text: str) -> bool:
    if not text.isascii():
        return _NEAR_BLANK.search(text) is not None
    return "  " in text or any(c in text and (f"{c} " in text or f" {c}" in text) for c in _ASCII_SPACE)


def token_bytes(spec: str) -> pa.Array:
    """Bytes of every id of a byte-level vocabulary, special strings included; unused ids are empty."""
    parsed, back = json.loads(spec), {c: b for b, c in byte_alphabet().items()}
    names = {i: s for s, i in parsed["model"]["vocab"].items()} | {t["id"]: t["content"] for t in parsed["added_tokens"]}
    of = lambda s: bytes(back[c] for c in s) if all(c in back for c in s) else s.encode()
    return pa.array([of(names[i]) if i in names else b"" for i in range(max(names) + 1)], pa.large_binary())


def decode(ids: bytes, table: pa.Array) -> str:
    """Text of ids given as little-endian unsigned 32-bit integers; broken UTF-8 becomes U+FFFD."""
    if not ids:
        return ""
    # values that are taken lie one behind another
    return table.take(pa.array(np.frombuffer(ids, "<u4"))).buffers()[2].to_pybytes().decode("utf-8", "replace")


def frequent_words(docs: DataFrame, spec: str, text_col: str, share: float, size: int) -> list[str]:
    """The ``size`` most frequent words with at least ``share`` of all words, counted in all texts.

    Tasks count chunks, of which few are distinct, split only those into words, and hand on what they have when a table is full;
    Spark adds up. Texts that the library encodes whole have no words. At most ``1 / share`` words reach the driver.
    """
    sent, key = docs.sparkSession.sparkContext.broadcast(spec), ("words", hashlib.sha256(spec.encode()).hexdigest())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = latest_per_process("bpe", key, lambda: WordEncoder(sent.value))
        chunks = Counter()

        def words() -> pa.RecordBatch:
            seen, total = Counter(), 0
            for c, n in chunks.items():
                for w in enc.words(c):
                    total += n
                    if len(w) <= CACHE_LENGTH:
                        seen[w] += n
            names, counts = [None, *seen], [total, *seen.values()]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

        for b in batches:
            for run in _runs(t.as_py() for t in b.column(0)):
                for text in run:
                    chunks.update(enc.chunks(text) or ())
                if len(chunks) > COUNTED_CHUNKS:
                    yield words()
                    chunks.clear()
        yield words()

    found = map_batches(docs.select(text_or_empty(text_col).alias("t")), counted, "word string, n long")
    sums = materialise(found.groupBy("word").agg(F.sum("n").alias("n")))
    total = sums.filter("word IS NULL").agg(F.sum("n")).first()[0] or 0
    top = sums.filter(F.col("word").isNotNull() & (F.col("n") >= total * share)).orderBy(F.desc("n"), "word").limit(size)
    return [r.word for r in top.collect()]


def build_lexicon(docs: DataFrame, spec: str, text_col: str = "text", share: float = 2e-6, size: int = 65_536) -> str:
    """Compile the frequent words, hand the file to every executor, and return its name there.

    ``size`` bounds the file (a few megabytes). Executors that join later fetch it with their first task.
    """
    words = frequent_words(docs, spec, text_col, share, size)
    enc = WordEncoder(spec)
    data = compile_lexicon(zip((w.encode() for w in words), (np.frombuffer(i, "<u4").tolist() for i in enc._merge(words))))
    folder = tempfile.mkdtemp(prefix="lexicon-")
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:16]}-{os.path.basename(folder)}.bin"
    with open(os.path.join(folder, name), "wb") as f:
        f.write(data)
    docs.sparkSession.sparkContext.addFile(os.path.join(folder, name))
    return name


def encode_documents(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", lexicon: str | None = None
) -> DataFrame:
    """Per row ``(id, ids)``: the ids of the whole text as binary, little-endian unsigned 32-bit integers.

    Equal to the library's encoding without added special tokens, truncation or padding; special strings
    inside a text become their id. Null counts as empty and gives no ids; row ids pass through, null or
    repeated; no rows give no rows. ``lexicon`` is the name that ``build_lexicon`` returned.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    return _encoded(docs, spec, id_col, text_col, lexicon, "ids binary", lambda ids, table: (pa.array(ids, pa.binary()),))


def _encoded(docs, spec, id_col, text_col, lexicon, columns, make) -> DataFrame:
    sent, key = docs.sparkSession.sparkContext.broadcast(spec), ("bpe", hashlib.sha256(spec.encode()).hexdigest(), lexicon)
    ranked = merges_by_rank(spec)
    rows = docs.select(cell(id_col).alias("id"), text_or_empty(text_col).alias("t"))
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL(columns).fields])

    def started():
        return WordEncoder(sent.value, Lexicon(SparkFiles.get(lexicon)) if lexicon else None, ranked), token_bytes(sent.value)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, table = latest_per_process("bpe", key, started)
        for b in batches:
            at = 0
            for run in _runs(t.as_py() for t in b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(run)), *make(enc.encode(run), table)], schema.names)
                at += len(run)

    return map_batches(rows, encoded, schema)


def round_trip(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", lexicon: str | None = None
) -> DataFrame:
    """Per row ``(id, n_tokens, ids_sha256, decoded_sha256)``: digests of the ids and of the text decoded from them."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()

    def digests(ids: list[bytes], table: pa.Array) -> tuple[pa.Array, ...]:
        sha = lambda data: hashlib.sha256(data).hexdigest()
        back = [sha(decode(i, table).encode("utf-8")) for i in ids]
        return pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([sha(i) for i in ids]), pa.array(back)

    return _encoded(docs, spec, id_col, text_col, lexicon, "n_tokens long, ids_sha256 string, decoded_sha256 string", digests)
