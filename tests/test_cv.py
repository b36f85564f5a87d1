import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneflow.operators import cv, sampling


def by_residuals(x, y, fold, held, rounds):
    """Exact recursion on the residual: the fitted part of the residual halves in every round."""
    train, test = fold != held, fold == held
    q, s, v = np.linalg.svd(x[train], full_matrices=False)
    keep = s > 1e-9 * s[0]
    project = lambda r: (v[keep].T / s[keep]) @ (q[:, keep].T @ r)
    residual = y[train].copy()
    for _ in range(rounds):
        step = project(residual)
        residual = residual - x[train] @ step / 2
    level = (y[train] - residual).mean()
    return float(np.mean((x[test] @ step / 2 + level - y[test]) ** 2))


def data(n=300):
    rng = np.random.default_rng(3)
    a, b = rng.gamma(2, 3, n), rng.integers(1, 7, n).astype(float)
    y = 3 + 2.5 * a - b + rng.normal(0, 2, n)
    return a, b, y


CASES = {
    "plain": lambda a, b: {"a": a, "b": b},
    "constant": lambda a, b: {"a": a, "c": np.full_like(a, 7.5)},
    "collinear": lambda a, b: {"a": a, "b": b, "twice": 2 * a},
    "offset": lambda a, b: {"a": a, "b": b, "shifted": 3 * b - 40.0},
    "large": lambda a, b: {"a": a, "b": 1e6 + b},
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("rounds", [1, 5, 50, 600])
def test_scores_equal_the_recursion(spark, case, rounds):
    a, b, y = data()
    cols = CASES[case](a, b)
    fold = np.arange(len(y)) % 5
    rows = [(int(f), *map(float, v), float(t)) for f, *v, t in zip(fold, *cols.values(), y)]
    design = spark.createDataFrame(rows, "fold int, " + ", ".join(f"{c} double" for c in cols) + ", y double")
    out = cv.grid_scores(design, list(cols), "y", combos=1, folds=5, rounds=rounds).collect()
    # shifting and scaling a feature changes no prediction, and keeps the plain version's digits
    x = np.column_stack([np.ones(len(y)), *((c - c.mean()) / (c.std() or 1) for c in cols.values())])
    assert len(out) == 5
    for r in out:
        assert r.score == pytest.approx(by_residuals(x, y, fold, r.fold, rounds), rel=1e-7), (case, r.fold)


def test_grid_shape(spark):
    g = cv.grid(spark, 12, 5, 50)
    rows = g.collect()
    assert g.rdd.getNumPartitions() == 60
    assert {(r.combo, r.fold) for r in rows} == {(c, f) for c in range(12) for f in range(5)}
    assert all(r.rounds == 50 * (1 + r.combo) for r in rows)


def test_grid_map_sees_side_data(spark):
    side = spark.createDataFrame([(0, 10.0), (1, 20.0)], "fold int, v double")
    out = cv.grid_map(cv.grid(spark, 2, 2, 1), side, lambda p: p[["combo", "fold"]].assign(z=p["v"] + p["combo"]),
                      "combo int, fold int, z double")
    assert sorted(tuple(r) for r in out.collect()) == [(0, 0, 10.0), (0, 1, 20.0), (1, 0, 11.0), (1, 1, 21.0)]


def test_train_is_all_other_folds(spark):
    df = spark.createDataFrame([(i % 3, 1e6 + i, float(i * i)) for i in range(12)], "fold int, a double, y double")
    stats = cv.fold_statistics(df, ["a"], "y")
    train = {r.fold: r for r in cv.train_statistics(stats, ["a"], 3).collect()}
    for f in range(3):
        i = np.array([i for i in range(12) if i % 3 != f], float)
        a, y = 1e6 + i, i * i
        assert train[f].n == len(i) and train[f].m0 == pytest.approx(a.mean()) and train[f].my == pytest.approx(y.mean())
        assert train[f].v0x0 == pytest.approx(a.var()) and train[f].vyy == pytest.approx(y.var())
        assert train[f].v0y == pytest.approx(np.cov(a, y, ddof=0)[0, 1])


def test_scores_by_hand(spark):
    """Two points a fold: the other fold's line goes through its points."""
    rows = [(0, 0.0, 0.0), (0, 2.0, 4.0), (1, 0.0, 1.0), (1, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "fold int, a double, y double")
    out = {(r.fold, r.rounds): r.score for r in cv.grid_scores(df, ["a"], "y", combos=2, folds=2, rounds=1).collect()}
    # fold 0 by the line 1 + x with mean 1.5: half of it after one round, a quarter after two
    for n in (1, 2):
        s = 0.5**n
        want = np.mean([(1.5 + s * (1 + a - 1.5) - y) ** 2 for a, y in ((0, 0), (2, 4))])
        assert out[0, n] == pytest.approx(want)
        want = np.mean([(2 + s * (2 * a - 2) - y) ** 2 for a, y in ((0, 1), (1, 2))])
        assert out[1, n] == pytest.approx(want)


def test_missing_fold_scores_null(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (0, 2.0, 2.0)], "fold int, a double, y double")
    scores = cv.grid_scores(df, ["a"], "y", combos=1, folds=2, rounds=1).collect()
    assert [r.score for r in scores] == [None, None]


def test_design_matrix_drops_incomplete(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (None, 1.0, 1.0), (1, float("nan"), 1.0), (1, 1.0, None)], "a int, b double, y double")
    out = cv.design_matrix(df, ["a", "b"], "y")
    assert out.dtypes == [(c, "double") for c in ("intercept", "a", "b", "y")]
    assert [tuple(r) for r in out.collect()] == [(1.0, 1.0, 2.0, 3.0)]


def test_statistics_are_one_combined_aggregate(spark):
    df = spark.range(100).select((F.col("id") % 5).cast("int").alias("fold"), F.col("id").cast("double").alias("a"),
                                 F.col("id").cast("double").alias("y"))
    plan = cv.fold_statistics(df, ["a"], "y")._jdf.queryExecution().executedPlan().toString()
    assert "partial_covar_pop" in plan and plan.count("Exchange") == 1


def test_sample_and_folds_do_not_depend_on_partitions(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") * 7).alias("j"))
    ids = lambda d: sorted(r.id for r in d.select("id").collect())
    want = ids(sampling.sample_rows(df, ["id", "j"], fraction=0.3))
    assert 1300 < len(want) < 1700
    for n in (1, 4, 16):
        assert ids(sampling.sample_rows(df.repartition(n), ["id", "j"], fraction=0.3)) == want
    folds = lambda d: sorted((r.id, r.fold) for r in sampling.with_folds(d, ["id"]).select("id", "fold").collect())
    assert folds(df.repartition(1)) == folds(df.repartition(16))
    sizes = [r["count"] for r in sampling.with_folds(df, ["id"]).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and all(850 < n < 1150 for n in sizes)


def test_a_tiny_fraction_is_not_rounded_to_none(spark):
    df = spark.range(1_000_000)
    assert sampling.sample_rows(df, ["id"], fraction=5e-7).count() <= 5
    low = df.select("id", sampling.key_hash(["id"], f"sample{sampling.SAMPLE_SEED}").alias("h")).orderBy("h").first()
    above = (low.h + 1) / 2**60
    assert above < 1e-4
    assert [r.id for r in sampling.sample_rows(df, ["id"], fraction=above * (1 + 1e-9)).collect()] == [low.id]
    assert sampling.sample_rows(df, ["id"], fraction=above * (1 - 1e-6)).count() == 0


def test_folds_of_a_sample_are_balanced(spark):
    rows = sampling.with_folds(sampling.sample_rows(spark.range(200_000), ["id"], fraction=0.05), ["id"])
    sizes = [r["count"] for r in rows.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and all(1700 < n < 2300 for n in sizes)


def test_null_and_text_keys(spark):
    df = spark.createDataFrame([(None, "a"), (None, None), (1, "a"), (1_000_000, "b"), (2_000_000, "b")], "id long, k string")
    kept = lambda f: {(r.id, r.k) for r in sampling.sample_rows(df, ["id", "k"], fraction=f).collect()}
    assert len(kept(1.0)) == 5 == len(kept(7.0)) and kept(0.0) == set()
    for a, b in ((0.2, 0.5), (0.5, 0.9)):
        assert kept(a) <= kept(b)
    assert all(0 <= r.fold < 5 for r in sampling.with_folds(df, ["id", "k"]).collect())


def test_sample_fraction_is_clamped():
    assert sampling.sample_fraction(0) == 1.0
    assert sampling.sample_fraction(100) == 1.0
    assert sampling.sample_fraction(400_000) == 0.5


def test_large_and_negative_keys(spark):
    df = spark.createDataFrame([(2**62,), (-5,), (9_000_000_000,)], "id long")
    assert sampling.sample_rows(df, ["id"], fraction=0.999999).count() <= 3
    assert all(0 <= r.fold < 5 for r in sampling.with_folds(df, ["id"]).collect())


def test_bernoulli(spark):
    df = spark.range(10_000)
    n = sampling.sample_rows(df, ["id"], target=1000, method="bernoulli").count()
    assert 800 < n < 1200


def test_factors_keep_digits_that_moments_lose(spark):
    """Two features that differ by a millionth (condition 1e7): scores as from the rows' own least squares."""
    rng = np.random.default_rng(4)
    n = 3000
    a = rng.normal(5.0, 1.0, n)
    b = a + 1e-6 * rng.normal(size=n)
    y = 3 * a - 2e5 * (b - a) + rng.normal(0, 0.1, n)
    fold = np.arange(n) % 5
    rows = spark.createDataFrame([(int(f), *map(float, x)) for f, *x in zip(fold, a, b, y)], "fold int, a double, b double, y double").repartition(7)
    got = {(r.combo, r.fold): r.score for r in cv.grid_scores_by_factors(rows, ["a", "b"], "y", combos=3, rounds=1).collect()}
    assert len(got) == 15
    for f in range(5):
        x = np.column_stack([np.ones(n), a, b])
        train = fold != f
        center = x[train][:, 1:].mean(0)
        z = np.column_stack([np.ones(n), a - center[0], b - a - (center[1] - center[0])])  # the same columns' span, well conditioned
        scale = np.linalg.norm(z[train], axis=0)
        w = np.linalg.lstsq(z[train] / scale, y[train], rcond=None)[0] / scale
        fitted, mean = z[~train] @ w, y[train].mean()
        for c in range(3):
            s = 0.5 ** (1 + c)
            want = np.mean((s * fitted + (1 - s) * mean - y[~train]) ** 2)
            assert got[c, f] == pytest.approx(want, rel=1e-9)


def test_factors_agree_with_moments_and_survive_odd_input(spark):
    rows = [(i % 5, float(i % 7), 2.0, 2 * float(i % 7), float(i % 11)) for i in range(200)]  # constant and dependent columns
    df = spark.createDataFrame(rows, "fold int, a double, c double, d double, y double")
    key = lambda d: {(r.combo, r.fold): r.score for r in d.collect() if r.score is not None}
    names = ["a", "c", "d"]
    factors, moments = key(cv.grid_scores_by_factors(df, names, "y", 2, rounds=1)), key(cv.grid_scores(df, names, "y", 2, rounds=1))
    assert factors.keys() == moments.keys() and all(factors[k] == pytest.approx(moments[k], rel=1e-9) for k in moments)
    few = spark.createDataFrame([(0, 1.0, 1.0), (0, 2.0, 2.0), (1, 3.0, None), (1, 4.0, 1.0)], "fold int, a double, y double")
    assert len(key(cv.grid_scores_by_factors(few, ["a"], "y", 1))) == 2
    assert cv.grid_scores_by_factors(few.limit(0), ["a"], "y", 1).collect() == []
