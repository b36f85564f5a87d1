"""Repeated byte strings, found by hashes of fixed windows at difference-cover samples, sorted one bucket at a time.

Suffixes themselves are not sorted. Rolling hashes only rule out what is certainly single; what is equal is decided by 96
bits of XXH3 over the window's bytes, under a secret seed drawn for the call, so no text can be written to collide.
"""

from __future__ import annotations

import secrets
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_digest

from zoneflow.llm.common import cell, give_back, map_batches, materialise, new_path, per_process, rows_and_bytes, text_or_empty
from zoneflow.llm.hashing import Rolling, mix

# Sample period q*q + q + 1 for this q: of any 73 neighbouring positions 9 are samples.
COVER_ORDER = 8
# Text that one task holds at a time, and sample ranks that one bucket holds on average.
PART_BYTES, BUCKET_RANKS = 8 * 1024 * 1024, 1_000_000
MAX_TABLE_BUCKETS = 50_000
_SLICE = 1 << 20
NARROW, WIDE, SHIFTS, KEPT = 0, 1, 2, 3  # kinds of ranks; KEPT is no rank but what a part found out, for itself


def difference_cover(q: int = COVER_ORDER) -> tuple[int, tuple[int, ...]]:
    """Period ``v`` and a set of residues whose differences reach every residue.

    So for any two positions there is a shift below ``v`` that moves both onto sample positions.
    """
    return per_process(("cover", q), lambda: _search_cover(q))


def _search_cover(q: int) -> tuple[int, tuple[int, ...]]:
    v = q * q + q + 1

    def extend(chosen: list[int], used: set[int]) -> list[int] | None:
        if len(chosen) == q + 1:
            return chosen
        for x in range(chosen[-1] + 1, v):
            fresh = [d for y in chosen for d in ((x - y) % v, (y - x) % v)]
            if len(set(fresh)) == len(fresh) and not used.intersection(fresh):
                found = extend([*chosen, x], used.union(fresh))
                if found:
                    return found
        return None

    found = extend([0, 1], {1, v - 1})
    if found is None:
        raise ValueError(f"no perfect difference set of order {q}")
    return v, tuple(found)


class Part:
    """The documents of one part as one array of bytes, and the positions that matter in it."""

    def __init__(self, texts: list[bytes], window: int):
        self.sizes = np.array([len(t) for t in texts], "i8")
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.data = np.frombuffer(b"".join(texts), "u1")
        self.window, self.shared = window, window - difference_cover()[0] + 1

    def samples(self) -> np.ndarray:
        """Sample positions that a repeat of ``window`` bytes can use.

        The shift that aligns two equal strings is below the period, so the sample's next ``shared`` bytes
        lie inside both.
        """
        v, cover = difference_cover()
        shared = self.shared
        longest = int(self.sizes.max(initial=0))
        grid = (np.arange(0, longest + v, v)[:, None] + np.array(cover)).ravel()
        usable = np.searchsorted(grid, np.maximum(0, self.sizes - shared + 1) * (self.sizes >= self.window))
        out = [grid[:n] + s for s, n in zip(self.starts, usable) if n]
        return np.concatenate(out) if out else np.empty(0, "i8")

    def end_of(self, at: np.ndarray) -> np.ndarray:
        return self.ends[np.searchsorted(self.starts, at, "right") - 1] if len(at) else at

    def digests(self, at: np.ndarray, length: int, key: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The next ``length`` bytes at each position as 64 and 32 bits of their digest under a secret seed."""
        whole, seed = self.data.tobytes(), int.from_bytes(key[:8], "little")
        raw = np.frombuffer(b"".join([xxh3_128_digest(whole[a : a + length], seed) for a in at.tolist()]), "u8").reshape(-1, 2)
        return raw[:, 0].copy(), raw[:, 1] & np.uint64(0xFFFFFFFF)

    def hashes(self, at: np.ndarray, length: int, rolling: Rolling) -> np.ndarray:
        """A number for the next ``length`` bytes at each (sorted) position; unequal numbers mean unequal bytes."""
        out = np.empty(len(at), "u8")
        for a in range(0, len(self.data), _SLICE):
            lo, hi = np.searchsorted(at, [a, a + _SLICE])
            if lo < hi:
                prefix = rolling.prefix(self.data[a : a + _SLICE + length])
                out[lo:hi] = mix(rolling.between(prefix, at[lo:hi] - a, at[lo:hi] - a + length))
        return out


def _spread(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """All integers of the disjoint, sorted ranges ``[start, stop)``."""
    n = stop - start
    return np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else start


def _merged(start: np.ndarray, stop: np.ndarray, limit: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges sorted by start. With ``limit``, ranges with another limit are kept apart."""
    if not len(start):
        return start, stop
    reach = np.maximum.accumulate(stop)
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    if limit is not None:
        new[1:] |= limit[1:] != limit[:-1]
    first = np.flatnonzero(new)
    return start[first], np.concatenate([reach[first[1:] - 1], reach[-1:]])


def _by_rank(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Order by both parts of a rank. One fast sort does unless two ranks agree in their first part only."""
    order = np.argsort(high)
    same = high[order][1:] == high[order][:-1]
    if np.any(low[order][1:][same] != low[order][:-1][same]):
        order = np.lexsort((low, high))
    return order


class Ranks:
    """Ranks of some positions of a part, reduced to distinct ones in sorted order.

    ``wide`` ranks have 96 bits and decide what is equal; narrow ones send 40 bits within a bucket and only
    rule out what is certainly single. ``shifts`` asks for a range of shifts at each position (first and last,
    255 and 0 for none); equal ranks ask for the range that holds all of theirs.
    """

    def __init__(self, part: Part, at: np.ndarray, length: int, key: bytes | None, shifts: tuple | None = None):
        wide = key is not None
        self.at, self.kind = at, WIDE if wide else SHIFTS if shifts else NARROW
        if wide:
            high, low = part.digests(at, length, key)
        else:
            high, low = part.hashes(at, length, per_process("rolling", Rolling)), np.zeros(len(at), "u8")
        order = _by_rank(high, low)
        high, low = high[order], low[order]
        new = np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]) if len(at) else np.empty(0, bool)
        self.place = np.empty(len(at), "i8")
        self.place[order] = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        self.high, self.low, self.wide = high[first], low[first], wide
        self.twice = np.diff(np.concatenate([first, [len(at)]])) > 1
        if shifts and len(at):
            self.shifts = _widest(shifts[0][order], shifts[1][order], first)
        elif shifts:
            self.shifts = np.empty((0, 2), "u1")

    def bucket(self, buckets: int) -> np.ndarray:
        return ((self.high >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)

    def rows(self, part: int, buckets: int) -> Iterator[tuple[int, int, bytes, bytes]]:
        """``(bucket, part, ranks, whether each occurs twice in this part)``; a rank is sent once per part."""
        b = self.bucket(buckets).astype("i8")
        cut = np.concatenate([[0], np.flatnonzero(np.diff(b)) + 1, [len(b)]]) if len(b) else [0]
        for lo, hi in zip(cut, cut[1:]):
            raw = np.ascontiguousarray(self.high[lo:hi]).view("u1").reshape(-1, 8)
            if self.wide:
                raw = np.hstack([raw, np.ascontiguousarray(self.low[lo:hi]).view("u1").reshape(-1, 8)[:, :4]])
            else:
                raw = raw[:, :5]
            more = self.shifts[lo:hi] if self.kind == SHIFTS else np.packbits(self.twice[lo:hi])
            yield int(b[lo]), part, raw.tobytes(), more.tobytes()

    def asked(self, answers: dict[int, bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last shift that any equal rank asks for, at each position."""
        b = self.bucket(buckets).astype("i8")
        out = np.tile(np.array([255, 0], "u1"), (len(b), 1))
        for bucket, raw in answers.items():
            if bucket < 0:
                continue
            lo, hi = np.searchsorted(b, [bucket, bucket + 1])
            out[lo:hi] = np.frombuffer(raw, "u1").reshape(-1, 2)
        out = out[self.place].astype("i8") if len(b) else np.empty((0, 2), "i8")
        return out[:, 0], out[:, 1]

    def repeated(self, answers: dict[int, bytes], buckets: int) -> np.ndarray:
        """The positions whose rank occurs elsewhere, from the answers of the buckets."""
        b = self.bucket(buckets).astype("i8")
        flags = np.zeros(len(b), bool)
        for bucket, bits in answers.items():
            if bucket < 0:
                continue
            lo, hi = np.searchsorted(b, [bucket, bucket + 1])
            flags[lo:hi] = np.unpackbits(np.frombuffer(bits, "u1"), count=hi - lo).astype(bool)
        return self.at[flags[self.place]] if len(flags) else self.at


def _widest(low: np.ndarray, high: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Smallest first and largest last shift of each run of rows."""
    return np.stack([np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)], axis=1).astype("u1")


def _chosen(at: np.ndarray, some: np.ndarray) -> bytes:
    """Bits that tell which of the sorted positions ``at`` are in ``some``."""
    bits = np.zeros(len(at), bool)
    bits[np.searchsorted(at, some)] = True
    return np.packbits(bits).tobytes()


def sort_bucket(table: pa.Table) -> pa.Table:
    """One bucket of ranks, sorted. For every part: which of its ranks occur more than once anywhere, or the
    widest range of shifts that an equal rank asks for."""
    kind = table.column("kind")[0].as_py()
    if kind == KEPT:
        return pa.table({"part": table.column("part"), "bucket": table.column("bucket"), "answer": table.column("ranks")})
    sent = [np.frombuffer(x.as_py(), "u1") for x in table.column("ranks")]
    raw = np.concatenate(sent).reshape(-1, 12 if kind == WIDE else 5)
    sizes = [len(s) // raw.shape[1] for s in sent]

    def number(columns: np.ndarray) -> np.ndarray:
        out = np.zeros((len(raw), 8), "u1")
        out[:, : columns.shape[1]] = columns
        return out.view("u8").ravel()

    high = number(raw[:, :8] if kind == WIDE else raw)
    low = number(raw[:, 8:]) if kind == WIDE else np.zeros(len(raw), "u8")
    order = _by_rank(high, low)
    same = high[order][1:] == high[order][:-1]
    if kind == WIDE:
        same &= low[order][1:] == low[order][:-1]
    cuts = np.cumsum(sizes)[:-1]
    if kind == SHIFTS:
        asked = np.frombuffer(b"".join(x.as_py() for x in table.column("more")), "u1").reshape(-1, 2)[order]
        first = np.flatnonzero(np.concatenate([[True], ~same]))
        out = np.empty((len(raw), 2), "u1")
        out[order] = np.repeat(_widest(asked[:, 0], asked[:, 1], first), np.diff([*first, len(raw)]), axis=0)
        answers = [x.tobytes() for x in np.split(out, cuts)]
    else:
        found = np.zeros(len(raw), bool)
        found[order[1:][same]] = True
        found[order[:-1][same]] = True
        own = [np.unpackbits(np.frombuffer(x.as_py(), "u1"), count=n) for x, n in zip(table.column("more"), sizes)]
        answers = [np.packbits(f | o.astype(bool)).tobytes() for f, o in zip(np.split(found, cuts), own)]
    return pa.table({"part": table.column("part"), "bucket": table.column("bucket"), "answer": pa.array(answers, pa.binary())})


class Search:
    """The four sorts as seen from one part; each needs the answers to the ones before."""

    def __init__(self, texts: list[bytes], window: int, buckets: int, answers: dict[int, dict[int, bytes]], key: bytes):
        self.part, self.window, self.buckets, self.answers = Part(texts, window), window, buckets, answers
        self.key = key
        self.keep: bytes | None = None

    def _kept(self, step: int, at: np.ndarray) -> np.ndarray | None:
        """Positions that an earlier pass over this part chose among ``at``."""
        bits = self.answers.get(step, {}).get(-1)
        return None if bits is None else at[np.unpackbits(np.frombuffer(bits, "u1"), count=len(at)).astype(bool)]

    def first(self) -> Ranks:
        """All cover samples by the bytes that any aligned repeat shares after them."""
        return Ranks(self.part, self.part.samples(), self.part.shared, None)

    def second(self) -> Ranks | None:
        """Samples that are not single, by a whole window: the inside of every long repeat."""
        samples = self.part.samples()
        self.near = self._kept(2, samples)
        if self.near is None:
            self.near = self.first().repeated(self.answers.get(1, {}), self.buckets)
            self.keep = _chosen(samples, self.near)
        if -1 in self.answers.get(3, {}):
            return None  # answered and kept
        at = self.near[self.near + self.window <= self.part.end_of(self.near)]
        return Ranks(self.part, at, self.window, self.key)

    def third(self) -> Ranks:
        """What is still open: starts just before such a sample whose window no found repeat covers.

        A start's partner may lie inside a longer repeat, where nothing is open. So the samples say how far before
        them starts are open, and all samples of one rank learn the widest answer.
        """
        ranks = self.second()
        self.inside = self._kept(3, self.near)
        if self.inside is None:
            self.inside = ranks.repeated(self.answers.get(2, {}), self.buckets)
            self.keep = _chosen(self.near, self.inside)
        v, _ = difference_cover()
        near, part = self.near, self.part
        self.begin, self.last = part.starts[np.searchsorted(part.starts, near, "right") - 1], part.end_of(near) - self.window
        at = self.starts(np.zeros(len(near), "i8"), np.full(len(near), v - 1))
        x, y = _merged(self.inside, self.inside + self.window)
        if len(x):
            k = np.searchsorted(x, at, "right") - 1
            at = at[(k < 0) | (at + self.window > y[np.maximum(k, 0)])]
        lo, hi = np.searchsorted(at, np.maximum(self.begin, near - v + 1)), np.searchsorted(at, near, "right")
        some = lo < hi
        shift = np.full(len(near), 255), np.zeros(len(near), "i8")
        shift[0][some], shift[1][some] = near[some] - at[hi[some] - 1], near[some] - at[lo[some]]
        return Ranks(part, near, part.shared, None, shift)

    def starts(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Starts of whole windows that lie ``low`` to ``high`` before each sample, in its document."""
        a, b = np.maximum(self.begin, self.near - high), np.minimum(self.near - low, self.last) + 1
        order = np.flatnonzero(a < b)
        order = order[np.argsort(a[order], kind="stable")]
        at = _spread(*_merged(a[order], b[order]))
        return at[at + self.window <= self.part.end_of(at)]  # touching ranges run on into the next document

    def fourth(self) -> Ranks:
        """The starts that were asked for, by a whole window: the ends of long repeats, and short ones."""
        low, high = self.third().asked(self.answers.get(3, {}), self.buckets)
        return Ranks(self.part, self.starts(low, high), self.window, self.key)

    def spans(self) -> list[list[tuple[int, int]]]:
        """Maximal covered runs of each document, in its own byte positions."""
        starts = np.union1d(self.fourth().repeated(self.answers.get(4, {}), self.buckets), self.inside).astype("i8")
        x, y = _merged(starts, starts + self.window, self.part.end_of(starts))
        out: list[list[tuple[int, int]]] = [[] for _ in self.part.sizes]
        for doc, a, b in zip(np.searchsorted(self.part.starts, x, "right") - 1, x, y):
            base = self.part.starts[doc]
            out[doc].append((int(a - base), int(b - base)))
        return out


def _stored_parts(docs: DataFrame, text_col: str, size: int) -> DataFrame:
    """The documents as a table ``(row, part)`` that is bucketed by part, so later passes move no text.

    ``row`` holds all input columns. A part is a run of neighbouring documents with about ``PART_BYTES`` of text (a
    single longer text is a part of its own).
    """
    size_of = F.octet_length(text_or_empty(text_col)).cast("long")
    rows = docs.select(F.struct(*(cell(c) for c in docs.columns)).alias("row"), size_of.alias("n"), F.spark_partition_id().alias("p"))
    schema = T.StructType([rows.schema["row"], T.StructField("part", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no, held = 0, 0
        for b in batches:
            parts = []
            for n, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                if held and held + n > PART_BYTES:
                    no, held = no + 1, 0
                held += n
                parts.append(p << 32 | no)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(parts, pa.int64())], schema.names)

    spark, name = docs.sparkSession, f"zoneflow_parts_{uuid.uuid4().hex}"
    buckets = min(MAX_TABLE_BUCKETS, max(1, -(-size // PART_BYTES)))
    made = map_batches(rows, cut, schema).write.option("compression", "zstd").option("path", new_path(spark, "parts"))
    made.bucketBy(buckets, "part").saveAsTable(name, format="parquet")
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    return spark.table(name).select("part", "row", text.alias("t"))


def repeats(
    docs: DataFrame, make: Callable[[pa.Table, list[list[tuple[int, int]]]], pa.Table], schema: T.StructType,
    text_col: str = "text", window: int = 200,
) -> DataFrame:
    """``make(rows, spans)`` for all documents: byte runs covered by a ``window``-byte string that starts elsewhere too.

    Texts are UTF-8 bytes (null: empty); strings never cross documents; repeats inside one document and
    overlapping ones count, and all are judged on the input. ``rows`` has the input's columns in ``row``.

    A repeat of ``window`` bytes at two places has a shift below the cover's period that puts both on sample
    positions. So only samples are ranked at first, by the bytes that such an aligned pair must share. Ranks
    are dealt into buckets by value, each bucket is sorted by one task of bounded memory, and ties decide;
    what stays single leaves. Ties are resolved by the rank of a whole window, for the samples that are left
    and then for the starts beside them that found repeats leave open, with their partners. Ranks are fingerprints, so equal strings
    are neighbours in a sorted bucket; their order is not the alphabet's, which no step needs.

    A part sends each rank once however often it occurs, so a passage that a third of all documents share is
    a row per part. A bucket answers with one bit per rank. The stored table keeps the text where it is.
    """
    n, size = rows_and_bytes(docs, text_col)
    v, cover = difference_cover()
    if window < 2 * v:
        raise ValueError(f"windows have at least {2 * v} bytes")
    buckets = max(1, -(-size * len(cover) // (v * BUCKET_RANKS)))
    stored, secret = _stored_parts(docs, text_col, size), secrets.token_bytes(16)
    text_at = docs.columns.index(text_col)
    empty = docs.sparkSession.createDataFrame([], "step int, part long, bucket int, answer binary")
    answers = empty

    def search(left: pa.Table, right: pa.Table) -> Search:
        known: dict[int, dict[int, bytes]] = {}
        for step, bucket, answer in zip(*(right.column(c).to_pylist() for c in ("step", "bucket", "answer"))):
            known.setdefault(step, {})[bucket] = answer
        return Search(_texts(left, text_at), window, buckets, known, secret)

    def ask(step: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        def asked(left: pa.Table, right: pa.Table) -> pa.Table:
            found = search(left, right)
            ranks = (found.first, found.second, found.third, found.fourth)[step - 1]()
            part = left.column("part")[0].as_py()
            rows = [(*r, ranks.kind, 0) for r in ranks.rows(part, buckets)]
            if found.keep is not None:  # spares later passes the sort of all samples
                rows.append((-1, part, found.keep, b"", KEPT, part))
            kinds = (
                ("bucket", pa.int32()), ("part", pa.int64()), ("ranks", pa.binary()), ("more", pa.binary()), ("kind", pa.int32()), ("own", pa.int64())
            )
            out = pa.table({c: pa.array([r[i] for r in rows], kind) for i, (c, kind) in enumerate(kinds)})
            del found, ranks, rows
            give_back()
            return out

        return asked

    texts = stored.select("part", "t")
    for step in (1, 2, 3, 4):
        sent = texts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
            ask(step), "bucket int, part long, ranks binary, more binary, kind int, own long"
        )
        got = sent.groupBy("bucket", "own").applyInArrow(sort_bucket, "part long, bucket int, answer binary")
        got = got.select(F.lit(step).alias("step"), "part", "bucket", "answer")
        answers = materialise(answers.unionAll(got))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        out = make(left, search(left, right).spans())
        give_back()
        return out

    return stored.select("part", "row").groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(finish, schema)


def _texts(rows: pa.Table, text_at: int) -> list[bytes]:
    """UTF-8 of the texts of a table with a column ``t`` or ``row``."""
    if "t" in rows.column_names:
        parts = rows.column("t").chunks
    else:
        parts = [c.flatten()[text_at] for c in rows.column("row").chunks]
    return [t or b"" for p in parts for t in p.cast(pa.string()).cast(pa.binary()).to_pylist()]


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def repeat_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 200) -> DataFrame:
    """Per row ``(id, n_bytes, n_removed, spans, kept)``: the covered byte runs and the bytes outside them.

    Row ids pass through, null or repeated; null and empty texts have no bytes and no spans; no rows give
    no rows. A text that occurs twice and has ``window`` bytes is covered whole, in every copy.
    """
    docs = docs.select(cell(id_col).alias("id"), text_or_empty(text_col).alias("t"))
    more = T.StructType.fromDDL("n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary").fields

    def make(rows: pa.Table, spans: list[list[tuple[int, int]]]) -> pa.Table:
        texts = _texts(rows, 1)
        return pa.table(
            {
                "id": pa.chunked_array([c.flatten()[0] for c in rows.column("row").chunks], type=rows.schema.field("row").type[0].type),
                "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                "n_removed": pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                "spans": pa.array(
                    [[{"start": a, "end": b} for a, b in s] for s in spans],
                    pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                ),
                "kept": pa.array([_kept(t, s) for t, s in zip(texts, spans)], pa.binary()),
            }
        )

    return repeats(docs, make, T.StructType([docs.schema["id"], *more]), "t", window)


def whole_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans shrunk to the characters that lie in them entirely, so that what is kept is valid UTF-8."""
    out = []
    inner = lambda i: i < len(text) and text[i] & 0xC0 == 0x80
    for a, b in spans:
        while a < b and inner(a):
            a += 1
        while a < b and inner(b):
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def drop_repeats(docs: DataFrame, text_col: str = "text", chars_col: str | None = None, window: int = 200) -> DataFrame:
    """All rows of ``docs`` with their columns; texts without the characters that repeated runs cover entirely.

    Null texts stay null. ``chars_col`` names a column that holds the text's length in characters; it is set
    to the new length where the text changed.
    """
    names, schema = docs.columns, docs.schema

    def make(rows: pa.Table, spans: list[list[tuple[int, int]]]) -> pa.Table:
        whole = rows.column("row").combine_chunks()
        whole = whole.combine_chunks() if isinstance(whole, pa.ChunkedArray) else whole
        columns = dict(zip(names, whole.flatten()))
        texts, sizes = columns[text_col].to_pylist(), columns[chars_col].to_pylist() if chars_col else []
        for i, s in enumerate(spans):
            if s:
                raw = texts[i].encode()
                texts[i] = _kept(raw, whole_characters(raw, s)).decode()
                if chars_col:
                    sizes[i] = len(texts[i])
        columns[text_col] = pa.array(texts, pa.string())
        if chars_col:
            columns[chars_col] = pa.array(sizes, columns[chars_col].type)
        return pa.table(columns)

    return repeats(docs, make, schema, text_col, window)
