"""Packing token sequences: first-fit decreasing over a tournament tree, in randomised groups of documents."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.llm.bpe import WordEncoder, _runs, merges_by_rank
from zoneflow.llm.common import cell, map_batches, per_process, rows_and_bytes, text_or_empty

# Text that one group holds on average. A group is packed in one task's memory, and what it leaves in its last,
# partly filled sequence is its only loss, so the number of groups grows with the input.
GROUP_BYTES = 16 * 1024 * 1024


class Tournament:
    """Free room of up to ``n`` bins; a node holds the larger room of its two halves."""

    def __init__(self, n: int, room: int):
        self.leaves = 1
        while self.leaves < max(1, n):
            self.leaves *= 2
        self.best = [room] * (2 * self.leaves)

    def first(self, size: int) -> int:
        """The first bin with room for ``size``; every bin starts empty, so there is one."""
        best, at = self.best, 1
        while at < self.leaves:
            at *= 2
            if best[at] < size:
                at += 1
        return at - self.leaves

    def take(self, where: int, size: int) -> None:
        best, at = self.best, where + self.leaves
        best[at] -= size
        at //= 2
        while at:
            left, right = best[2 * at], best[2 * at + 1]
            best[at] = left if left > right else right
            at //= 2


def first_fit_decreasing(sizes: list[int], room: int) -> list[list[int]]:
    """Bins of item numbers; each item goes, largest first, to the first bin that it fits."""
    tree, bins = Tournament(len(sizes), room), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        b = tree.first(sizes[i])
        tree.take(b, sizes[i])
        if b == len(bins):
            bins.append([])
        bins[b].append(i)
    return bins


def pack_group(lengths: list[int], room: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces ``(document, start, length)`` that hold every token of a group once.

    Whole multiples of ``room`` are cut off the front of long documents. The remainders are packed by first-fit
    decreasing; then the gaps of the fuller bins are closed with pieces cut from the emptiest ones, and the one
    bin left over is cut into powers of two, which need no padding. So no sequence of a group is padded when
    ``room`` is a power of two.
    """
    full, rest = [], []
    for doc, n in enumerate(lengths):
        full.extend([(doc, s, room)] for s in range(0, n - room + 1, room))
        if n % room:
            rest.append((doc, n - n % room, n % room))
    bins = [[rest[i] for i in b] for b in first_fit_decreasing([r[2] for r in rest], room)]
    bins.sort(key=lambda b: -sum(p[2] for p in b))
    gaps = [room - sum(p[2] for p in b) for b in bins]
    low, high = 0, len(bins) - 1
    while low < high:
        if not gaps[low]:
            low += 1
            continue
        doc, start, length = bins[high].pop()
        n = min(length, gaps[low])
        bins[low].append((doc, start, n))
        gaps[low] -= n
        gaps[high] += n
        if n < length:
            bins[high].append((doc, start + n, length - n))
        if not bins[high]:
            high -= 1
    packed = bins[: high + 1]
    if packed and 0 < gaps[high]:
        left, size = packed.pop(), room - gaps[high]
        while size:
            part, want = [], 1 << (size.bit_length() - 1)
            size -= want
            while want:
                doc, start, length = left.pop(0)
                n = min(length, want)
                part.append((doc, start, n))
                want -= n
                if n < length:
                    left.insert(0, (doc, start + n, length - n))
            packed.append(part)
    return full + packed


def pack_documents(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", room: int = 4096, end_id: int = 2,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """Per piece ``(id, start, length, ids, doc_tokens, sequence_id, offset)``.

    A document's ids are the library's for its whole text (no added special tokens) and ``end_id``; null counts
    as empty, so it is that one id. Each id lies in exactly one piece. ``ids`` is binary, little-endian unsigned
    32-bit. Row ids pass through, null or repeated (repeated rows are packed each). No rows give no rows.

    Groups are drawn by hashing the row's place in the input, so a source, an id or a text that holds a third
    of all rows is spread like any other. The text moves once, to its group; ids are made there and do not
    move. Numbers of sequences are unique over all groups.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    _, size = rows_and_bytes(docs, text_col)
    groups = max(1, -(-size // group_bytes))
    sent, key = docs.sparkSession.sparkContext.broadcast(spec), ("ranked words", hashlib.sha256(spec.encode()).hexdigest())
    ranked = merges_by_rank(spec)
    rows = docs.select(cell(id_col).alias("id"), text_or_empty(text_col).alias("t"))
    place = F.xxhash64(F.lit("group"), F.monotonically_increasing_id())
    dealt = rows.withColumn("g", F.pmod(place, F.lit(groups))).repartition(groups, "g")
    schema = T.StructType(
        [
            rows.schema["id"],
            *T.StructType.fromDDL("start long, length long, ids binary, doc_tokens long, sequence_id long, offset long").fields,
        ]
    )
    end = np.array([end_id], "<u4").tobytes()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = per_process(key, lambda: WordEncoder(sent.value, ranked=ranked))
        held, names = defaultdict(list), []  # a task holds a few groups of bounded size
        at = 0
        for b in batches:
            names.append(b.column(0))
            group, done = b.column(2).to_pylist(), 0
            for run in _runs(t.as_py() for t in b.column(1)):
                for ids in enc.encode(run):
                    held[group[done]].append((at + done, ids + end))
                    done += 1
            at += len(group)
        names = pa.chunked_array(names) if names else None
        for g in sorted(held):
            members = held.pop(g)
            out = []
            for s, pieces in enumerate(pack_group([len(ids) // 4 for _, ids in members], room)):
                offset = 0
                for doc, start, length in pieces:
                    out.append((doc, start, length, g << 32 | s, offset))
                    offset += length
            for i in range(0, len(out), 2000):
                part = out[i : i + 2000]
                ids = [members[d][1][4 * s : 4 * (s + n)] for d, s, n, _, _ in part]
                yield pa.RecordBatch.from_arrays(
                    [
                        names.take(pa.array([members[p[0]][0] for p in part])).combine_chunks(),
                        pa.array([p[1] for p in part], pa.int64()),
                        pa.array([p[2] for p in part], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([len(members[p[0]][1]) // 4 for p in part], pa.int64()),
                        pa.array([p[3] for p in part], pa.int64()),
                        pa.array([p[4] for p in part], pa.int64()),
                    ],
                    schema.names,
                )

    return map_batches(dealt, packed, schema)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
