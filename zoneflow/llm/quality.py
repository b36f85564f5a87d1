"""Quality of texts by a generalised additive model with pairwise interactions."""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.llm.common import cell, map_batches, send, text_or_empty
from zoneflow.sources.workdir import broadcast_if_small

# The model is fitted on at most this many labelled rows, chosen by a hash of their id.
TRAIN_ROWS = 20_000

FEATURES = (
    "log_bytes", "upper", "lower", "digit", "blank", "stop_marks", "symbols", "high_bytes", "newlines",
    "word_length", "capital_words", "distinct_words", "distinct_pairs", "repeated_next", "top_word", "distinct_lines",
    "short_words", "marked_words",
)

_SYMBOLS = np.frombuffer(rb"""!"#$%&*+/<=>@[\]^_`{|}~""", "u1")
_STOPS = np.frombuffer(b".,;:'()?-", "u1")


def text_features(text: str) -> list[float]:
    """Shares and averages over the whole text; an empty text has zeros. No list of words, no language."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), "u1")
    size = len(raw)
    if not size:
        return [0.0] * len(FEATURES)
    byte = np.zeros(256, "i8")
    for at in range(0, size, 1 << 20):  # a very long text needs no table of its own length
        byte += np.bincount(raw[at : at + (1 << 20)], minlength=256)
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    counts = Counter(words)
    after = words[1:]
    marks = sum(c * w[-1:].isalnum() for w, c in counts.items())
    return [
        np.log1p(size),
        byte[65:91].sum() / size,
        byte[97:123].sum() / size,
        byte[48:58].sum() / size,
        (byte[32] + byte[9]) / size,
        byte[_STOPS].sum() / size,
        byte[_SYMBOLS].sum() / size,
        byte[128:].sum() / size,
        byte[10] / size,
        min(60.0, len(text) / n),
        sum(c for w, c in counts.items() if w.isupper() and len(w) > 1) / n,
        len(counts) / n,
        len(set(zip(words, after))) / n,
        sum(map(operator.eq, words, after)) / n,
        max(counts.values(), default=0) / n,
        len(set(lines)) / len(lines),
        sum(c for w, c in counts.items() if len(w) < 4) / n,
        1 - marks / n,
    ]


@dataclass
class AdditiveModel:
    """Intercept, one table per feature over its bins, and one table per chosen pair over coarser bins."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds by looking up and adding bins; ``x`` has a row per text and a column per feature."""
        out = np.full(len(x), self.intercept)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            out += t[np.searchsorted(e, x[:, j], "right")]
        used = {j for p in self.pairs for j in p}
        coarse = {j: np.searchsorted(self.pair_edges[j], x[:, j], "right") for j in used}
        for (i, j), t in zip(self.pairs, self.pair_tables):
            out += t[coarse[i], coarse[j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _gain(g, h, penalty):
    return g * g / (h + penalty)


def _best_cut(g: np.ndarray, h: np.ndarray, lo: int, hi: int, penalty: float) -> tuple[float, int]:
    """Best place to cut bins ``lo..hi`` in two, and what that gains."""
    if hi - lo < 2:
        return 0.0, lo
    gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
    gs, hs = g[lo:hi].sum(), h[lo:hi].sum()
    gain = _gain(gl, hl, penalty) + _gain(gs - gl, hs - hl, penalty) - _gain(gs, hs, penalty)
    k = int(np.argmax(gain))
    return float(gain[k]), lo + k + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray, penalty: float) -> np.ndarray:
    """Two levels of cuts over the bins of one feature; the leaf value for each bin."""
    out, cuts = np.zeros(len(g)), [0, len(g)]
    for _ in range(2):
        fresh = []
        for lo, hi in zip(cuts, cuts[1:]):
            gain, at = _best_cut(g, h, lo, hi, penalty)
            if gain > 1e-9:
                fresh.append(at)
        cuts = sorted({*cuts, *fresh})
    for lo, hi in zip(cuts, cuts[1:]):
        out[lo:hi] = -g[lo:hi].sum() / (h[lo:hi].sum() + penalty)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Best tree that cuts both features of a pair once: its gain and the leaf value for each cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    parts = lambda c: (
        c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1],
        c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + c[:-1, :-1],
    )
    pg, ph = parts(cg), parts(ch)
    gain = sum(_gain(a, b, penalty) for a, b in zip(pg, ph))
    i, j = np.unravel_index(np.argmax(gain), gain.shape)
    leaf = [-a[i, j] / (b[i, j] + penalty) for a, b in zip(pg, ph)]
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = leaf
    return float(gain[i, j] - _gain(cg[-1, -1], ch[-1, -1], penalty)), out


def _cuts(x: np.ndarray, n: int) -> np.ndarray:
    """Edges of at most ``n`` bins with about equally many rows, between distinct values."""
    values = np.unique(x)
    if len(values) <= n:
        return (values[1:] + values[:-1]) / 2
    return np.unique(np.quantile(x, np.linspace(0, 1, n + 1)[1:-1]))


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.15, bins: int = 48, coarse: int = 12,
    n_pairs: int = 8, penalty: float = 2.0,
) -> AdditiveModel:
    """Boost one feature after the other, round by round, then the most useful pairs on what is left.

    Each step fits a shallow tree to the gradients summed over a feature's bins, so a feature's trees add up to
    one table. No labels, or one class only, give the constant model.
    """
    d = x.shape[1] if x.ndim == 2 else len(FEATURES)
    rate_of_ones = (y.sum() + 0.5) / (len(y) + 1.0)
    f0 = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    if len(y) == 0 or y.min() == y.max():
        none = [np.empty(0)] * d
        return AdditiveModel(f0, none, [np.zeros(1)] * d, none, [], [])
    edges = [_cuts(x[:, j], bins) for j in range(d)]
    binned = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    f = np.full(len(y), f0)

    def slopes():
        p = 1 / (1 + np.exp(-f))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for j in range(d):
            g, h = slopes()
            step = rate * _shallow_tree(
                np.bincount(binned[j], g, len(tables[j])), np.bincount(binned[j], h, len(tables[j])), penalty
            )
            tables[j] += step
            f += step[binned[j]]
    pair_edges = [_cuts(x[:, j], coarse) for j in range(d)]
    rough = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(pair_edges)]
    sizes = [len(e) + 1 for e in pair_edges]

    def grid(i: int, j: int, w: np.ndarray) -> np.ndarray:
        return np.bincount(rough[i] * sizes[j] + rough[j], w, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])

    g, h = slopes()
    able = [j for j in range(d) if sizes[j] > 1]
    gains = {(i, j): _quadrants(grid(i, j, g), grid(i, j, h), penalty)[0] for i in able for j in able if i < j}
    pairs = sorted(gains, key=lambda p: (-gains[p], p))[:n_pairs]
    pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in pairs]
    for _ in range(rounds // 2):
        for k, (i, j) in enumerate(pairs):
            g, h = slopes()
            step = rate * _quadrants(grid(i, j, g), grid(i, j, h), penalty)[1]
            pair_tables[k] += step
            f += step[rough[i], rough[j]]
    return AdditiveModel(f0, edges, tables, pair_edges, pairs, pair_tables)


def feature_rows(texts: list[str]) -> np.ndarray:
    return np.array([text_features(t) for t in texts], "f8").reshape(-1, len(FEATURES))


def _held_out(id_col: Column, folds: int) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    folds: int = 5, max_rows: int = TRAIN_ROWS,
) -> AdditiveModel:
    """Fit on labelled documents whose id is not held out: at most about ``max_rows`` of them.

    The rows are chosen by a hash of the id, so the choice does not depend on partitions. Features are
    computed in the tasks that read the texts; only they and the label reach the driver
    (``max_rows`` x 18 numbers). Rows with a null id or label are not used.
    """
    key = cell(id_col)
    usable = labels.select(key.alias("id"), cell(label_col).cast("int").alias("y")).filter(
        F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~_held_out(F.col("id"), folds)
    )
    n = usable.count()
    # a share of the hash range, 2^62 steps; a little below the bound so that chance does not pass it
    share = min(1.0, 0.95 * max_rows / max(1, n))
    mix = F.xxhash64(F.lit("train"), F.col("id"))
    chosen = usable if n <= max_rows else usable.filter(F.shiftrightunsigned(mix, 2) < int(share * 2**62))
    rows = docs.select(key.alias("id"), text_or_empty(text_col).alias("t")).join(broadcast_if_small(chosen), "id").select("id", "t", "y")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [text_features(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(x, pa.list_(pa.float64()))], ["id", "y", "x"])

    schema = T.StructType([rows.schema["id"], T.StructField("y", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    got = sorted((str(r.id), r.y, tuple(r.x)) for r in map_batches(rows, features, schema).toLocalIterator())[:max_rows]
    return fit(np.array([x for _, _, x in got], "f8").reshape(-1, len(FEATURES)), np.array([y for _, y, _ in got], "f8"))


def score_documents(
    docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, folds: int = 5
) -> DataFrame:
    """Per row ``(id, held_out, score, predicted)``; nothing but the whole text enters the score.

    Null counts as empty; empty texts get the score of all-zero features. A null id is never held out. Equal
    texts get equal scores. No rows give no rows. One pass, no shuffle; the model (a few kilobytes) is broadcast.
    """
    sent = send(docs, model)
    rows = docs.select(cell(id_col).alias("id"), _held_out(cell(id_col), folds).alias("held_out"), text_or_empty(text_col).alias("t"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = sent().score(np.array([text_features(t.as_py()) for t in b.column(2)], "f8").reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.float64())], ["id", "held_out", "score"])

    schema = T.StructType([rows.schema["id"], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])
    return map_batches(rows, scored, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: AdditiveModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns, in one pass."""
    sent, names, schema = send(docs, model), docs.columns, docs.schema
    at = names.index(text_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([text_features(t.as_py() or "") for t in b.column(at)], "f8").reshape(-1, len(FEATURES))
            yield b.filter(pa.array(sent().score(x) >= threshold))

    return map_batches(docs, kept, schema)
