"""Exact top-k inner products by three phases with a uniform threshold over slices of the vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import cell, map_batches, materialise

SLICES = 2  # parts of a vector that are scored apart
QUERY_BLOCK, CANDIDATE_BLOCK = 512, 8192  # a block pair's score table has at most 32 MB
# A vector is short when its scaled components fit 32 bits and the sum of their squares this; any score, or part of
# one, of two short vectors then fits it as well. The others are long; pairs with a long one are scored apart.
SHORT_SQUARES = 1 << 62
_SCORE = "decimal(20,0)"  # holds every long, and one more at each end for what does not fit


def scaled(vector: Column, scale: int) -> tuple[Column, Column]:
    """``floor(scale * x)`` of each component, x as double: the short vector, and the long one as whole doubles.

    The one that does not apply is empty. A double holds every floor exactly; a product beyond doubles is an error.
    """
    of = lambda x: x.cast("double") * scale
    most = F.greatest(F.abs(of(F.array_max(vector))), F.abs(of(F.array_min(vector)))) + 1  # a floor may lie one below
    short = F.coalesce((most < (1 << 31)) & (most * most * F.size(vector) < SHORT_SQUARES), F.lit(True))
    too_big = F.raise_error(F.lit("a scaled component does not fit a double")).cast("double")
    whole = lambda y: F.when(F.abs(y) < (1 << 53), F.floor(y).cast("double")).when(F.abs(y) < float("inf"), y).otherwise(too_big)
    return (
        F.when(short, F.transform(vector, lambda x: F.floor(of(x)).cast("int"))).otherwise(F.array().cast("array<int>")),
        F.when(~short, F.transform(vector, lambda x: whole(of(x)))).otherwise(F.array().cast("array<double>")),
    )


def _usable(vector: Column) -> Column:
    fine = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, fine), F.lit(False))


def _blocks(rows: DataFrame, width: int, size: int, with_cut: bool) -> DataFrame:
    """Rows ``(uid, v[, cut])`` as ``(slice, uids, m, cut)``: one matrix per slice for each run of rows.

    Shorter vectors are filled up with zeros.
    """
    at = [width * s // SLICES for s in range(SLICES + 1)]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, size):
                b = whole.slice(first, size)
                m = np.zeros((b.num_rows, width), "<i4")
                for i, v in enumerate(b.column(1)):
                    m[i, : len(v)] = v.values.to_numpy(zero_copy_only=False)
                uids = b.column(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
                cut = b.column(2).to_numpy(zero_copy_only=False).astype("<i8").tobytes() if with_cut else b""
                parts = [m[:, at[s] : at[s + 1]].tobytes() for s in range(SLICES)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(SLICES), pa.int32()), pa.array([uids] * SLICES, pa.binary()),
                        pa.array(parts, pa.binary()), pa.array([cut] * SLICES, pa.binary()),
                    ],
                    ["slice", "uids", "m", "cut"],
                )

    return map_batches(rows.select("uid", "v", *(["cut"] if with_cut else [])), build, "slice int, uids binary, m binary, cut binary")


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; in floating point where every sum fits its 53 bits."""
    most = lambda x: int(np.abs(x).max(initial=0))
    if most(a) * most(b) * max(1, a.shape[1]) < 1 << 53:
        return (a.astype("f8") @ b.astype("f8").T).astype("i8")
    return a.astype("i8") @ b.astype("i8").T


def _meet(queries: DataFrame, candidates: DataFrame, parts: int, pick: Callable) -> DataFrame:
    """Rows ``(q, c, slice, score)`` that ``pick(scores, cut)`` marks in each pair of blocks of one slice.

    The query blocks are copied to each of ``parts`` shares of the candidates, which are not copied.
    """
    shares = candidates.withColumn("part", F.pmod(F.xxhash64("uids"), F.lit(parts)).cast("int")).drop("cut")
    sent = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    pairs = sent.select("part", "slice", F.col("uids").alias("qu"), F.col("m").alias("qm"), "cut").join(shares, ["part", "slice"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, qu, qm, cut, cu, cm in zip(*(b.column(i).to_pylist() for i in range(6))):
                qu, cu = np.frombuffer(qu, "<i8"), np.frombuffer(cu, "<i8")
                a, c = np.frombuffer(qm, "<i4").reshape(len(qu), -1), np.frombuffer(cm, "<i4").reshape(len(cu), -1)
                table = _products(a, c)
                i, j = pick(table, np.frombuffer(cut, "<i8"))
                for k in range(0, len(i), 200_000):
                    x, y = i[k : k + 200_000], j[k : k + 200_000]
                    cols = [pa.array(qu[x]), pa.array(cu[y]), pa.array(np.full(len(x), s, "i4")), pa.array(table[x, y])]
                    yield pa.RecordBatch.from_arrays(cols, ["q", "c", "slice", "score"])

    return map_batches(pairs.select("slice", "qu", "qm", "cut", "uids", "m"), score, "q long, c long, slice int, score long")


def _exact(pairs: DataFrame, queries: DataFrame, distinct: DataFrame) -> DataFrame:
    """``(q, c)`` with the whole inner product."""
    dot = F.aggregate(
        F.zip_with("a", "b", lambda x, y: F.coalesce(x.cast("long") * y.cast("long"), F.lit(0).cast("long"))),
        F.lit(0).cast("long"),
        lambda s, x: s + x,
    )
    left = pairs.join(queries.select(F.col("uid").alias("q"), F.col("v").alias("a")), "q")
    both = left.join(distinct.select(F.col("uid").alias("c"), F.col("v").alias("b")), "c")
    return both.select("q", "c", dot.alias("score"))


def _double_blocks(rows: DataFrame, width: int, size: int) -> DataFrame:
    """Rows ``(uid, low, v, w)`` as ``(uids, lows, m)``: one matrix of doubles for each run of rows."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, size):
                b = whole.slice(first, size)
                m = np.zeros((b.num_rows, width), "<f8")
                for column in (2, 3):
                    for i, v in enumerate(b.column(column)):
                        m[i, : len(v)] += v.values.to_numpy(zero_copy_only=False)
                uids, lows = (b.column(i).to_numpy(zero_copy_only=False).astype("<i8").tobytes() for i in range(2))
                cols = [pa.array([x], pa.binary()) for x in (uids, lows, m.tobytes())]
                yield pa.RecordBatch.from_arrays(cols, ["uids", "lows", "m"])

    return map_batches(rows.select("uid", "low", "v", "w"), build, "uids binary, lows binary, m binary")


def may_lead(a: np.ndarray, c: np.ndarray, few: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two matrices of whole doubles that can be among the ``few`` best of their row of ``a``.

    Scores are floating point here, with rows brought to a like size so that nothing overflows; a pair is
    left out only when its error bound proves that ``few`` others score higher.
    """
    size = lambda x: np.frexp(np.abs(x).max(axis=1, initial=0))[1]
    up = size(c)
    a, c = np.ldexp(a, -size(a)[:, None]), np.ldexp(c, -up[:, None])
    up = up - up.max(initial=0)
    norm = lambda x: np.sqrt((x * x).sum(axis=1))
    table = np.ldexp(a @ c.T, up)
    error = np.ldexp((a.shape[1] + 4) * 2.0**-51 * norm(a)[:, None] * norm(c), up) + 1e-290
    if table.shape[1] <= few:
        return np.nonzero(np.ones(table.shape, bool))
    bound = -np.partition(error - table, few - 1, axis=1)[:, few - 1]
    return np.nonzero(table + error >= bound[:, None])


def whole_scores(a: np.ndarray, c: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact inner products of the pairs ``a[i]``, ``c[j]`` of whole doubles, as Python integers."""
    out = np.zeros(len(i), object)
    most = lambda x: np.abs(x).max(axis=1, initial=0)
    high_a, high_c = most(a), most(c)
    with np.errstate(over="ignore"):
        fits = (high_a[i] < 2.0**62) & (high_c[j] < 2.0**62) & (high_a[i] * high_c[j] * max(1, a.shape[1]) < 2.0**62)
    at = np.nonzero(fits)[0]
    step = max(1, (1 << 20) // max(1, a.shape[1]))
    for k in range(0, len(at), step):
        x = at[k : k + step]
        out[x] = (a[i[x]].astype("i8") * c[j[x]].astype("i8")).sum(axis=1).tolist()
    rows: dict[tuple[bool, int], list[int]] = {}

    def integers(left: bool, r: int) -> list[int]:
        if (left, r) not in rows:
            rows[left, r] = [int(x) for x in (a if left else c)[r]]
        return rows[left, r]

    for x in np.nonzero(~fits)[0]:
        out[x] = sum(p * q for p, q in zip(integers(True, int(i[x])), integers(False, int(j[x]))))
    return out


def _long_scores(queries: DataFrame, candidates: DataFrame, width: int, parts: int, few: int) -> DataFrame:
    """``(q, c, score)``: of each block of candidates every query's ``few`` best by exact score, ties to smaller ``low``.

    A score that does not fit a long is set just beyond the longs on its side.
    """
    sent = _double_blocks(queries, width, QUERY_BLOCK).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    sent = sent.select("part", F.col("uids").alias("qu"), F.col("m").alias("qm"))
    shares = _double_blocks(candidates, width, CANDIDATE_BLOCK // 2).withColumn("part", F.pmod(F.xxhash64("uids"), F.lit(parts)).cast("int"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for qu, qm, cu, low, cm in zip(*(b.column(i).to_pylist() for i in range(5))):
                qu, cu, low = (np.frombuffer(x, "<i8") for x in (qu, cu, low))
                a, c = np.frombuffer(qm, "<f8").reshape(len(qu), -1), np.frombuffer(cm, "<f8").reshape(len(cu), -1)
                i, j = may_lead(a, c, few)
                for r in range(0, len(qu), 32):  # few rows at a time: with many ties a whole block stays
                    here = slice(*np.searchsorted(i, [r, r + 32]))
                    x, y = i[here], j[here]
                    scores = whole_scores(a, c, x, y).tolist()
                    place: dict[int, int] = {}
                    best = []
                    for n in sorted(range(len(x)), key=lambda n: (-scores[n], low[y[n]])):
                        place[x[n]] = place.get(x[n], 0) + 1
                        if place[x[n]] <= few:
                            best.append(n)
                    fitted = [Decimal(max(-(1 << 63) - 1, min(1 << 63, scores[n]))) for n in best]
                    cols = [pa.array(qu[x[best]]), pa.array(cu[y[best]]), pa.array(fitted, pa.decimal128(20, 0))]
                    yield pa.RecordBatch.from_arrays(cols, ["q", "c", "score"])

    pairs = sent.join(shares, "part").select("qu", "qm", "uids", "lows", "m")
    return map_batches(pairs, score, f"q long, c long, score {_SCORE}")


def top_k(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, scale: int = 1024
) -> DataFrame:
    """Per query ``(query_id, rank, id, score)``: its ``k`` highest integer inner products, ties to smaller ids.

    Vectors are turned into ``floor(scale * x)``; those that are null or hold null or non-finite components,
    and rows with a null id, take no part. Shorter vectors count as filled up with zeros. A query's own id is
    no candidate; rows that repeat a query's id each get the full answer's rows once. No rows give no rows.

    Components have no bound. Pairs of vectors whose scores are sure to fit 64 bits go the way of ``_short_scores``;
    every pair with another vector is scored in ``_long_scores``, exactly as well. An answer whose score does not
    fit a long is an error.

    Equal vectors are scored once: of a group of copies only the ``k + 1`` smallest ids can appear in any
    answer, so a vector that a third of all rows share is one candidate.
    """
    rows = vectors.filter(is_query | cell(id_col).isNotNull()).select(
        cell(id_col).cast("long").alias("id"), cell(vector_col).alias("raw"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    v, w = scaled(F.col("raw"), scale)
    rows = rows.filter(F.col("id").isNotNull() & _usable(F.col("raw"))).select("id", v.alias("v"), w.alias("w"), "asks")
    rows = materialise(rows)
    vector = ["v", "w"]
    best = Window.partitionBy(*vector).orderBy("id")
    members = rows.select("id", *vector).distinct().withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
    members = materialise(members)
    distinct = materialise(
        members.filter("n = 1").select(F.monotonically_increasing_id().alias("uid"), *vector, F.col("id").alias("low"))
    )
    is_long = F.size("w") > 0
    n, n_long, width, width_long = distinct.agg(
        F.count(F.lit(1)), F.count_if(is_long), *(F.coalesce(F.max(F.size(x)), F.lit(0)) for x in vector)
    ).first()
    asked = rows.filter("asks").select("id", *vector).distinct()
    queries = materialise(distinct.join(asked.select(*vector).distinct(), vector).select("uid", *vector, "low"))
    n_queries, n_long_queries = queries.agg(F.count(F.lit(1)), F.count_if(is_long)).first()
    if not n_queries:
        return rows.limit(0).select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id"), F.lit(0).cast("long").alias("score")
        )
    scores = []
    if n_queries > n_long_queries:
        scores.append(_short_scores(queries.filter(~is_long), distinct.filter(~is_long), width, n - n_long, n_queries - n_long_queries, k))
    if n_long:
        wide, blocks = max(width, width_long), lambda rows: max(1, -(-rows // (CANDIDATE_BLOCK // 2)))
        far = lambda q, c, rows: _long_scores(q, c, wide, blocks(rows), k + 1)
        scores = [x.withColumn("score", F.col("score").cast(_SCORE)) for x in scores]
        scores.append(far(queries.filter(~is_long), distinct.filter(is_long), n_long))
        if n_long_queries:
            scores.append(far(queries.filter(is_long), distinct, n))
    scores = reduce(DataFrame.unionAll, scores).join(distinct.select(F.col("uid").alias("c"), "low"), "c")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "low")
    lists = scores.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1).select("q", "c", "score")
    # back from distinct vectors to rows
    named = distinct.select("uid", *vector)
    of_query = asked.join(named, vector).select(F.col("id").alias("query_id"), F.col("uid").alias("q"))
    of_member = members.join(named, vector).select("id", F.col("uid").alias("c"))
    answers = lists.join(of_query, "q").join(of_member, "c").filter("id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    score = F.col("score")
    if n_long:
        fits = score.between(F.lit(-(1 << 63)).cast(_SCORE), F.lit((1 << 63) - 1).cast(_SCORE))
        score = F.when(fits, score.cast("long")).otherwise(F.raise_error(F.lit("a score does not fit a long")).cast("long"))
    return ranked.select("query_id", "rank", "id", score.alias("score"))


def _short_scores(queries: DataFrame, distinct: DataFrame, width: int, n: int, n_queries: int, k: int) -> DataFrame:
    """``(q, c, score)`` of short vectors, with all that can be among a query's ``k + 1`` best.

    Phase one: each slice of the vectors gives every query a local list of its best part scores; the ones
    seen are scored whole, and the k-th best is a cutoff that no answer falls below. Phase two: the cutoff goes
    out with the queries. An answer's parts sum up to the cutoff at least, so one of them reaches its even share;
    every part score that does is collected. Phase three: what cannot reach the cutoff even if its unseen
    parts came just below the share is dropped, the rest is scored whole and ranked. Nothing is estimated.
    """
    parts = max(1, -(-n // CANDIDATE_BLOCK))
    spread = lambda q: q.repartition(max(1, -(-n_queries // QUERY_BLOCK)), "uid")
    candidates = materialise(_blocks(distinct, width, CANDIDATE_BLOCK, False))

    def local_lists(table: np.ndarray, _) -> tuple[np.ndarray, np.ndarray]:
        few = min(k + 1, table.shape[1])
        j = np.argpartition(-table, few - 1, axis=1)[:, :few]
        return np.repeat(np.arange(len(table)), few), j.ravel()

    seen = _meet(_blocks(spread(queries), width, QUERY_BLOCK, False), candidates, parts, local_lists)
    order = Window.partitionBy("q").orderBy(F.desc("score"))
    whole = _exact(seen.select("q", "c").distinct(), queries, distinct)
    cut = whole.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1).groupBy("q")
    # fewer candidates than asked for: everything is collected
    cut = cut.agg(F.when(F.count(F.lit(1)) > k, F.min("score")).otherwise(F.lit(-(1 << 62))).alias("cut"))
    cut = materialise(cut)

    def reach_share(table: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # least integer that is not below cut / SLICES
        return np.nonzero(table >= -((-cuts) // SLICES)[:, None])

    with_cut = spread(queries.join(cut, queries.uid == cut.q).select("uid", "v", "cut"))
    found = _meet(_blocks(with_cut, width, QUERY_BLOCK, True), candidates, parts, reach_share)
    known = found.groupBy("q", "c").agg(F.sum("score").alias("score"), F.count(F.lit(1)).alias("parts")).join(cut, "q")
    known = materialise(known)
    complete = known.filter(F.col("parts") == SLICES).select("q", "c", "score")
    open_ = known.filter((F.col("parts") < SLICES) & (SLICES * F.col("score") >= F.col("parts") * F.col("cut")))
    return complete.unionAll(_exact(open_.select("q", "c"), queries, distinct))
