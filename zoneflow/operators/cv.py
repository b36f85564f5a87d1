"""Grid scoring of a damped least-squares fit from per-fold moments.

The fit repeats ``rounds`` times: solve least squares for the residual, add half of the step.
Each repeat halves the weights, so with ``w`` the ordinary solution on the training rows the last
weights are ``0.5**(rounds-1) * w`` and the summed prediction is ``(1 - 0.5**rounds) * X w``. The
held-out score ``mean((0.5 * x.w_last + mean(pred) - y)**2)`` then needs only first and second
moments of each fold: one grouped aggregate over all rows serves every fit of the grid.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Features and target of the model, and the default grid.
FEATURES = ["trip_distance", "passenger_count", "mean_fare", "mean_tip_ratio", "p90_distance", "fare_per_km"]
TARGET = "fare_amount"
COMBOS = 12
FOLDS = 5
FIT_ROUNDS = 50
# Rows whose means the moments are shifted by.
SHIFT_ROWS = 100


def design_matrix(
    df: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET, keep: Sequence[str] = ()
) -> DataFrame:
    """Intercept, features and target as doubles; rows that miss any of them are dropped."""
    complete = df.na.drop(subset=[*features, target])
    return complete.select(
        *keep,
        F.lit(1.0).alias("intercept"),
        *(F.col(f).cast("double").alias(f) for f in features),
        F.col(target).cast("double").alias(target),
    )


def _pairs(features: Sequence[str]) -> list[tuple[int, int]]:
    return [(i, k) for i in range(len(features)) for k in range(i, len(features))]


def fold_statistics(
    rows: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET, fold: str = "fold"
) -> DataFrame:
    """Rows, means and population covariances per fold in one map-side combined aggregate.

    ``n``, ``my``, ``m0..``, ``vyy``, ``v0y..`` (with the target) and ``v0x0..``. Plain sums of products compile to straight
    code. Every column is shifted by its mean over a few rows first, so large values lose no digits.
    """
    columns = [*features, target]
    near = rows.select(*columns).head(SHIFT_ROWS)  # reads on only until there are as many
    known = [[r[i] for r in near if r[i] is not None and math.isfinite(r[i])] for i in range(len(columns))]
    shift = [sum(v) / len(v) if v else 0.0 for v in known]
    moved = rows.select(fold, *((F.col(c) - F.lit(shift[i])).alias(f"d{i}") for i, c in enumerate(columns)))
    p, d = len(features), lambda i: F.col(f"d{i}")
    products = [(i, k) for i in range(p + 1) for k in range(i, p + 1)]
    sums = moved.groupBy(fold).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.sum(d(i)).alias(f"s{i}") for i in range(p + 1)),
        *(F.sum(d(i) * d(k)).alias(f"s{i}_{k}") for i, k in products),
    )
    n = F.col("n")
    mean = lambda i: F.lit(shift[i]) + F.col(f"s{i}") / n
    cov = lambda i, k: F.col(f"s{i}_{k}") / n - (F.col(f"s{i}") / n) * (F.col(f"s{k}") / n)
    return sums.select(
        fold, "n", mean(p).alias("my"), F.greatest(cov(p, p), F.lit(0.0)).alias("vyy"),
        *(mean(i).alias(f"m{i}") for i in range(p)), *(cov(i, p).alias(f"v{i}y") for i in range(p)),
        *((F.greatest(cov(i, k), F.lit(0.0)) if i == k else cov(i, k)).alias(f"v{i}x{k}") for i, k in _pairs(features)),
    )


def _moments(row: dict, p: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Rows, means and covariance matrix of a fold, the target last."""
    mean = np.array([*(row[f"m{i}"] for i in range(p)), row["my"]], float)
    cov = np.empty((p + 1, p + 1))
    for i in range(p):
        cov[i, p] = cov[p, i] = row[f"v{i}y"]
        for k in range(i, p):
            cov[i, k] = cov[k, i] = row[f"v{i}x{k}"]
    cov[p, p] = row["vyy"]
    return float(row["n"]), mean, cov


def _pooled(parts: Sequence[tuple[float, np.ndarray, np.ndarray]]) -> tuple[float, np.ndarray, np.ndarray]:
    """Moments of several folds together: spread within the folds and between their means."""
    n = sum(p[0] for p in parts)
    mean = sum(p[0] * p[1] for p in parts) / n
    cov = sum(p[0] * (p[2] + np.outer(p[1] - mean, p[1] - mean)) for p in parts) / n
    return n, mean, cov


def _per_fold(stats: DataFrame, fn: Callable[[dict[int, tuple]], list[tuple]], p: int, schema: str, folds: int) -> DataFrame:
    """``fn`` over the moments of all folds, inside one task: they are at most ``folds`` rows."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = json.loads(batch["rows"].iloc[0] or "[]")
            moments = {r["fold"]: _moments(r, p) for r in rows}
            names = [c.split()[0] for c in schema.split(", ")]
            yield pd.DataFrame(fn(moments), columns=names)

    inside = stats.filter(F.col("fold").between(0, folds - 1))
    return inside.agg(F.to_json(F.collect_list(F.struct("*"))).alias("rows")).mapInPandas(each, schema)


def train_statistics(stats: DataFrame, features: Sequence[str] = FEATURES, folds: int = FOLDS) -> DataFrame:
    """Per held-out fold the same statistics over all other folds, from the folds' own."""
    p = len(features)

    def pooled(moments: dict[int, tuple]) -> list[tuple]:
        out = []
        for f in moments:
            others = [m for g, m in moments.items() if g != f]
            if others:
                n, mean, cov = _pooled(others)
                means, with_y = mean[:p].tolist(), [float(cov[i, p]) for i in range(p)]
                out.append((f, int(n), float(mean[p]), float(cov[p, p]), *means, *with_y, *(float(cov[i, k]) for i, k in _pairs(features))))
        return out

    kind = {"fold": "int", "n": "long"}
    schema = ", ".join(f"{c} {kind.get(c, 'double')}" for c in ["fold", *(c for c in stats.columns if c != "fold")])
    return _per_fold(stats, pooled, p, schema, folds)


def grid(spark: SparkSession, combos: int = COMBOS, folds: int = FOLDS, rounds: int = FIT_ROUNDS) -> DataFrame:
    """Every (combo, fold) pair with its number of rounds, one row per partition."""
    n = combos * folds
    i = F.col("id")
    return spark.range(0, n, 1, n).select(
        F.expr(f"int(id div {folds})").alias("combo"),
        (i % folds).cast("int").alias("fold"),
        (F.lit(rounds) * (1 + F.expr(f"id div {folds}"))).cast("int").alias("rounds"),
    )


def grid_map(
    cells: DataFrame, side: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, key: str = "fold"
) -> DataFrame:
    """Run ``fn`` on every grid cell with the cell's side data attached; the engine picks the join by real sizes."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return cells.join(side, key, "left").mapInPandas(each, schema)


def fold_solutions(stats: DataFrame, features: Sequence[str] = FEATURES, folds: int = FOLDS) -> DataFrame:
    """``fold, quad, lin, const``: the held-out score of ``rounds`` repeats is ``quad*s*s + lin*s + const``, s = 0.5**rounds.

    With ``b`` the slopes fitted on the other folds and ``m`` their means, a held-out row's prediction is
    ``s * (x - m).b`` above the mean target of the other folds; the score averages its squared error, which
    takes nothing but moments. One solve per fold serves every number of rounds. Features are scaled by their
    spread; those without any get no weight, and dependent ones share it.
    """
    p = len(features)

    def solve(moments: dict[int, tuple]) -> list[tuple]:
        out = []
        for f, (_, mean, cov) in moments.items():
            others = [m for g, m in moments.items() if g != f]
            if not others:
                continue
            _, m_t, c_t = _pooled(others)
            spread = np.sqrt(np.maximum(0, np.diag(c_t)[:p]))
            flat = spread <= 1e-12 * np.abs(m_t[:p])
            scale = np.where(flat, 1.0, spread)
            gram = np.where(np.outer(flat, flat) | flat[:, None] | flat[None, :], 0.0, c_t[:p, :p] / np.outer(scale, scale))
            b = np.linalg.lstsq(gram, np.where(flat, 0.0, c_t[:p, p] / scale), rcond=1e-10)[0] / scale
            u, v = float((mean[:p] - m_t[:p]) @ b), float(m_t[p] - mean[p])
            quad = float(b @ cov[:p, :p] @ b) + u * u
            lin = 2 * (u * v - float(b @ cov[:p, p]))
            out.append((f, quad, lin, float(cov[p, p]) + v * v))
        return out

    return _per_fold(stats, solve, p, "fold int, quad double, lin double, const double", folds)


def grid_scores(
    design: DataFrame,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    combos: int = COMBOS,
    folds: int = FOLDS,
    rounds: int = FIT_ROUNDS,
) -> DataFrame:
    """``combo, fold, rounds, score`` of every cell of the grid; null for a fold without rows on either side."""
    side = fold_solutions(fold_statistics(design, features, target), features, folds)
    s = F.pow(F.lit(0.5), F.col("rounds"))
    score = F.col("quad") * s * s + F.col("lin") * s + F.col("const")
    cells = grid(design.sparkSession, combos, folds, rounds).coalesce(1)
    return cells.join(side, "fold", "left").select("combo", "fold", "rounds", score.alias("score"))


def _upper(rows: np.ndarray) -> np.ndarray:
    """Triangular factor of ``rows``, square whatever their number."""
    width = rows.shape[1]
    if len(rows) < width:
        rows = np.vstack([rows, np.zeros((width - len(rows), width))])
    return np.linalg.qr(rows, mode="r")


_FACTOR = "fold int, n long, r array<double>"


def _merge_factors(factors: DataFrame, width: int, ways: int | None) -> DataFrame:
    """One factor per fold (and slice): a factor of stacked factors is the factor of all their rows."""
    slice_ = F.lit(0) if ways is None else F.pmod(F.xxhash64("r"), F.lit(ways)).cast("int")

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for fold, n, r in zip(batch["fold"], batch["n"], batch["r"]):
                one = np.asarray(r, float).reshape(-1, width)
                before = held.get(fold)
                held[fold] = (n, one) if before is None else (before[0] + n, _upper(np.vstack([before[1], one])))
        yield pd.DataFrame([(f, n, r.ravel().tolist()) for f, (n, r) in held.items()], columns=["fold", "n", "r"])

    # a task holds one small factor per fold, however many it merges
    return factors.withColumn("__slice", slice_).repartition("fold", "__slice").drop("__slice").mapInPandas(merged, _FACTOR)


def fold_factors(rows: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET, fold: str = "fold") -> DataFrame:
    """``fold, n, r``: the triangular factor of every fold's ``[1, features, target]``, row by row, from the rows themselves.

    Each task factors its rows batch by batch and keeps one factor per fold; factors are merged by slices first, then by
    fold. Moments square the condition number of the features; the factors do not, so nearly dependent features keep
    their digits. Rows that miss a value belong to no fold.
    """
    names = [*features, target]
    width = len(names) + 1
    slim = rows.na.drop(subset=names).select(F.col(fold).cast("int").alias("fold"), *(F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)))

    def factored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            folds, x = batch["fold"].to_numpy(), batch.iloc[:, 1:].to_numpy(float)
            x = np.column_stack([np.ones(len(x)), x])
            for f in np.unique(folds):
                part = x[folds == f]
                n, r = held.get(int(f), (0, np.empty((0, width))))
                held[int(f)] = (n + len(part), _upper(np.vstack([r, part])))
        yield pd.DataFrame([(f, n, r.ravel().tolist()) for f, (n, r) in held.items()], columns=["fold", "n", "r"])

    return _merge_factors(_merge_factors(slim.mapInPandas(factored, _FACTOR), width, 64), width, None)


def grid_scores_by_factors(
    design: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET, combos: int = COMBOS, folds: int = FOLDS, rounds: int = FIT_ROUNDS
) -> DataFrame:
    """The scores of ``grid_scores``, solved on the rows' factors instead of their moments.

    The weights of a fold solve least squares on the merged factors of the others; its score is the length of its own factor
    times the damped weights. Dependent features share their weight, as in a least-norm solution of scaled columns.
    """
    width = len(features) + 2

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = {r["fold"]: (r["n"], np.array(r["r"], float).reshape(-1, width)) for r in json.loads(batch["rows"].iloc[0] or "[]")}
            out = []
            for f, (n, own) in found.items():
                others = [r for g, (_, r) in found.items() if g != f]
                if not others:
                    continue
                r = _upper(np.vstack(others))
                scale = np.linalg.norm(r[:, :-1], axis=0)
                scale[scale == 0] = 1.0
                w = np.linalg.lstsq(r[:, :-1] / scale, r[:, -1], rcond=1e-13)[0] / scale
                # the factor's first row holds the sums: its intercept entry times the mean of a column is that column's entry
                mean = r[0, -1] / r[0, 0]
                for c in range(combos):
                    s = 0.5 ** (rounds * (1 + c))
                    v = s * w
                    v[0] += (1 - s) * mean
                    out.append((c, f, rounds * (1 + c), float(np.sum((own @ np.append(v, -1.0)) ** 2) / n)))
            yield pd.DataFrame(out, columns=["combo", "fold", "rounds", "score"])

    factors = fold_factors(design, features, target).filter(F.col("fold").between(0, folds - 1))
    rows = factors.agg(F.to_json(F.collect_list(F.struct("*"))).alias("rows"))
    return rows.mapInPandas(scored, "combo int, fold int, rounds int, score double")


def effective_parallelism(spark: SparkSession, cells: int) -> int:
    """Cells that can run at once."""
    return min(spark.sparkContext.defaultParallelism, cells)
