"""Language of texts: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.llm.common import cell, map_batches, send, text_or_empty

# Fitted on at most this many documents of each language, chosen by a hash of their id.
TRAIN_ROWS_PER_LANGUAGE = 1_000
MAX_LANGUAGES = 500
BUCKET_BITS, WIDTH = 15, 16
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
# ASCII other than letters becomes a blank; bytes of other characters stay
_BLANKED = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))
_RUN_BYTES = 1 << 20


def _letters(text: str) -> bytes:
    return b" " + text.lower().encode("utf-8", "replace").translate(_BLANKED) + b"    "


def _buckets(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the 3 and of the 4 bytes from each position on, and whether the position counts.

    The last four bytes of ``raw`` only complete earlier pieces. Pieces that start with two blanks say nothing.
    """
    b = raw.astype("u4")
    three = b[:-4] | b[1:-3] << 8 | b[2:-2] << 16
    four = three | b[3:-1] << 24
    shift = np.uint32(32 - BUCKET_BITS)
    use = (raw[:-4] != 32) | (raw[1:-3] != 32)
    return (three * np.uint32(0x9E3779B1)) >> shift, (four * np.uint32(0x85EBCA6B)) >> shift, use


def _document(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares."""
    three, four, use = _buckets(np.frombuffer(_letters(text), "u1"))
    ids, n = np.unique(np.concatenate([three[use], four[use]]), return_counts=True)
    return ids, (n / max(1, n.sum())).astype("f4")


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # buckets x languages: embedding and softmax layer multiplied out
    bias: np.ndarray
    temperature: float
    reject_below: float

    def scores(self, texts: list[str]) -> np.ndarray:
        """Calibrated probabilities, a row per text. Work and memory go by runs of bytes, not by text length."""
        sums, counts = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        run, ends, first = [], [], 0

        def add(parts: list[bytes], start: int) -> None:
            joined = np.frombuffer(b"".join(parts), "u1")
            sizes = np.array([len(p) for p in parts])
            owner_end = np.cumsum(sizes) - 4  # pieces start at least four bytes before a part's end
            three, four, use = _buckets(joined)
            use = use.copy()
            for e in owner_end[:-1]:
                use[e : e + 4] = False
            v = self.weights[three] + self.weights[four]
            v[~use] = 0
            begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            sums[start : start + len(parts)] += np.add.reduceat(v, begin, axis=0)
            counts[start : start + len(parts)] += 2 * np.add.reduceat(use.astype("i8"), begin)

        size = 0
        for i, text in enumerate(texts):
            raw = _letters(text)
            if len(raw) > _RUN_BYTES:  # a long text alone, in overlapping slices
                for at in range(0, len(raw) - 4, _RUN_BYTES):
                    add([raw[at : at + _RUN_BYTES + 4]], i)
                raw = b"     "
            if not run:
                first = i
            run.append(raw)
            size += len(raw)
            if size > _RUN_BYTES:
                add(run, first)
                run, size = [], 0
        if run:
            add(run, first)
        z = (sums / np.maximum(1, counts)[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True)) if len(texts) else z
        return z / z.sum(axis=1, keepdims=True) if len(texts) else z

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Best language and its calibrated probability; ``und`` and 0 for texts without a letter."""
        if not self.languages or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        p = self.scores(texts)
        best = p.argmax(axis=1)
        known = np.array([bool(_LETTER.search(t)) for t in texts])
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, known)]
        return names, np.where(known, p[np.arange(len(texts)), best], 0.0)


Features = tuple[np.ndarray, np.ndarray]  # as _document gives them


def _pieces(text: str, cuts: list[tuple[int, int]]) -> list[Features | None]:
    """Features of a text and of its pieces ``(at, size)``; None for a piece that is the whole text or has no letter."""
    parts = [text, *(text[at : at + size] for at, size in cuts)]
    return [_document(p) if i == 0 or (len(p) < len(text) and _LETTER.search(p)) else None for i, p in enumerate(parts)]


class Texts:
    """What ``fit`` asks of its texts, here for texts in memory."""

    def __init__(self, texts: list[str]):
        self.texts = texts

    def lengths(self) -> list[int]:
        """Characters of each text; -1 for one without a letter."""
        return [len(t) if _LETTER.search(t) else -1 for t in self.texts]

    def features(self, cuts: dict[int, list[tuple[int, int]]]) -> dict[int, list[Features | None]]:
        """``_pieces`` of each text named in ``cuts``."""
        return {i: _pieces(self.texts[i], c) for i, c in cuts.items()}


class TableTexts(Texts):
    """Texts that stay in a table ``(lang, place, tie, t)``; their features are made in the tasks.

    ``rows`` holds ``(lang, place, tie, length)`` of each text that takes part. Equal keys are equal texts.
    """

    def __init__(self, table: DataFrame, rows: list[tuple[str, int, int, int]]):
        self.table, self.rows = table, rows

    def lengths(self) -> list[int]:
        return [r[3] for r in self.rows]

    def features(self, cuts: dict[int, list[tuple[int, int]]]) -> dict[int, list[Features | None]]:
        wanted = defaultdict(list)
        for i, c in cuts.items():
            wanted[self.rows[i][:3]].append((i, c))
        sent = self.table.sparkSession.sparkContext.broadcast(dict(wanted))
        # copies of a row would each send the features of all copies
        table = self.table.dropDuplicates(["lang", "place", "tie"]) if any(len(w) > 1 for w in wanted.values()) else self.table

        def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for *key, t in zip(*(c.to_pylist() for c in b.columns)):
                    for i, c in sent.value.get(tuple(key), ()):
                        found = [(k, f) for k, f in enumerate(_pieces(t, c)) if f]
                        cols = [
                            pa.array([i] * len(found), pa.int32()), pa.array([k for k, _ in found], pa.int32()),
                            pa.array([f[0].astype("<u2").tobytes() for _, f in found], pa.binary()),
                            pa.array([f[1].astype("<f4").tobytes() for _, f in found], pa.binary()),
                        ]
                        yield pa.RecordBatch.from_arrays(cols, ["i", "k", "ids", "share"])

        out: dict[int, list[Features | None]] = {i: [None] * (1 + len(c)) for i, c in cuts.items()}
        for r in map_batches(table, made, "i int, k int, ids binary, share binary").toLocalIterator():
            out[r.i][r.k] = np.frombuffer(r.ids, "<u2").astype("u4"), np.frombuffer(r.share, "<f4")
        return out


def fit(texts: list[str] | Texts, langs: list[str], epochs: int = 12, rate: float = 4.0, batch: int = 64, seed: int = 1) -> LanguageModel:
    """Stochastic gradient descent over whole texts and short pieces of them.

    A fifth of the texts is left out of the descent to set the temperature (smallest log loss) and the
    rejection bound: the probability below which 1 % of the right answers fall. No texts give a model that
    answers ``und``; one language gives a model that always answers it.
    """
    languages = sorted(set(langs))
    if not languages:
        return LanguageModel([], np.zeros((1 << BUCKET_BITS, 0), "f4"), np.zeros(0), 1.0, 0.0)
    r = np.random.default_rng(seed)
    place = {k: i for i, k in enumerate(languages)}
    source = texts if isinstance(texts, Texts) else Texts(texts)
    lengths = source.lengths()
    spare = np.arange(len(lengths)) % 5 == 4 if len(lengths) >= 50 else np.zeros(len(lengths), bool)
    r.shuffle(spare)
    made: dict[bool, list] = {False: [], True: []}
    # short texts have to be told apart as well
    cuts = {i: [(int(r.integers(0, max(1, n - size))), size) for size in (25, 120)] for i, n in enumerate(lengths) if n >= 0}
    features = source.features(cuts)
    for i in cuts:
        made[bool(spare[i])] += [(*f, place[langs[i]]) for f in features[i] if f]
    rows, k = made[False], len(languages)
    e = (r.standard_normal((1 << BUCKET_BITS, WIDTH)) * 0.3).astype("f4")
    w, bias = np.zeros((WIDTH, k), "f4"), np.zeros(k, "f4")
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for part in np.array_split(r.permutation(len(rows)), max(1, len(rows) // batch)):
            if not len(part):
                continue
            ids, share = np.concatenate([rows[i][0] for i in part]), np.concatenate([rows[i][1] for i in part])
            sizes = np.array([len(rows[i][0]) for i in part])
            starts = np.cumsum(sizes) - sizes
            y = np.array([rows[i][2] for i in part])
            hidden = np.add.reduceat(e[ids] * share[:, None], starts, axis=0)
            z = hidden @ w + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), y] -= 1
            p /= len(part)
            back = np.repeat(p @ w.T, sizes, axis=0) * share[:, None]
            w -= step * hidden.T @ p
            bias -= step * p.sum(axis=0)
            for c in range(WIDTH):
                e[:, c] -= step * len(part) * np.bincount(ids, back[:, c], 1 << BUCKET_BITS).astype("f4")
    model = LanguageModel(languages, (e @ w).astype("f4"), bias.astype("f8"), 1.0, 0.0)
    if made[True]:
        z = np.stack([(model.weights[i] * s[:, None]).sum(axis=0) + bias for i, s, _ in made[True]]).astype("f8")
        y = np.array([t for _, _, t in made[True]])

        def probabilities(t: float) -> np.ndarray:
            q = np.exp((z - z.max(axis=1, keepdims=True)) / t)
            return q / q.sum(axis=1, keepdims=True)

        loss = lambda t: -np.log(np.maximum(1e-12, probabilities(t)[np.arange(len(y)), y])).mean()
        model.temperature = float(min(np.geomspace(0.2, 5, 40), key=loss))
        p = probabilities(model.temperature)
        right = p.max(axis=1)[p.argmax(axis=1) == y]
        model.reject_below = float(np.quantile(right, 0.01)) if len(right) else 0.0
    return model


def _fold(id_col: Column, folds: int) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, out: int = 1,
    per_language: int = TRAIN_ROWS_PER_LANGUAGE,
) -> LanguageModel:
    """Fit on rows with a language whose fold is not ``out``: at most ``per_language`` texts of each.

    Rows are chosen by a hash of their id within each language, so a rare language is not lost and the choice
    does not depend on partitions. Rows with a null id are not used. No text reaches the driver: one pass sends
    the lengths of the chosen ones, a second at most 2^15 numbers for each text and for two short pieces of it.
    """
    rows = docs.select(cell(id_col).alias("id"), text_or_empty(text_col).alias("t"), cell(lang_col).alias("lang")).filter(
        F.col("lang").isNotNull() & (_fold(F.col("id"), folds) != out)
    )
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return fit([], [])
    place = F.shiftrightunsigned(F.xxhash64(F.lit("train"), F.col("id")), 2)
    below = F.lit(0)
    for lang, n in sizes.items():
        share = 1.0 if n <= per_language else 0.9 * per_language / n
        below = F.when(F.col("lang") == lang, F.lit(int(share * 2**62))).otherwise(below)
    chosen = rows.filter(place < below).select("lang", place.alias("place"), F.xxhash64("t").alias("tie"), "t")

    def outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(Texts(b.column(3).to_pylist()).lengths(), pa.int64())], names)

    names = ["lang", "place", "tie", "n"]
    got = sorted(tuple(r) for r in map_batches(chosen, outlines, "lang string, place long, tie long, n long").toLocalIterator())
    taken: dict[str, int] = {}
    keep = [taken.__setitem__(g[0], taken.get(g[0], 0) + 1) or taken[g[0]] <= per_language for g in got]
    got = [g for g, k in zip(got, keep) if k]
    return fit(TableTexts(chosen, got), [g[0] for g in got])


def predict_language(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", folds: int = 3, out: int = 1
) -> DataFrame:
    """Per row ``(id, held_out, lang_pred, score, rejected)`` from the whole text alone.

    ``und`` with score 0 for null texts and texts without a letter; otherwise a learned language and its
    calibrated probability. ``rejected`` marks answers below the calibrated bound, and ``und``. A null id is not held
    out; equal texts get equal answers; no rows give no rows. One pass, no shuffle; the model (2^15 x languages
    numbers) is broadcast.
    """
    sent = send(docs, model)
    held = F.coalesce(_fold(cell(id_col), folds) == out, F.lit(False)).alias("held_out")
    rows = docs.select(cell(id_col).alias("id"), held, text_or_empty(text_col).alias("t"))
    schema = T.StructType([rows.schema["id"], *T.StructType.fromDDL("held_out boolean, lang_pred string, score double, rejected boolean").fields])

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, score = sent().predict([t.as_py() for t in b.column(2)])
            low = [n == UNKNOWN or s < sent().reject_below for n, s in zip(names, score)]
            cols = [b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(low, pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    return map_batches(rows, predicted, schema)
