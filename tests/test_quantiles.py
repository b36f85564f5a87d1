import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneflow.operators.quantiles import Quantile, summarise


def rows():
    """Key 1 is hot and continuous, 2 hot with heavy ties, 3 hot with gaps, 4 hot and all equal, 5 hot and
    empty, 6 and 7 small."""
    rnd = random.Random(7)
    out = [(1, rnd.gauss(0, 100)) for _ in range(900)]
    out += [(2, float(rnd.choice([1, 1, 1, 1, 2, 3, 50]))) for _ in range(700)]
    out += [(3, None if i % 9 == 0 else rnd.expovariate(0.01)) for i in range(500)]
    out += [(4, 5.0)] * 300 + [(5, None)] * 200 + [(6, 1.0), (6, 4.0), (7, None)]
    rnd.shuffle(out)
    return out


def linear(values, p):
    v = [x for x in values if x is not None]
    return float(np.quantile(v, p)) if v else None


def by_index(values, p):
    v = sorted(x for x in values if x is not None)
    return v[min(int(p * len(v)), len(v) - 1)] if v else None


LINEAR, INDEX = [0.0, 0.5, 0.9], [0.5, 1.0]
QUANTILES = (
    [Quantile(f"l{i}", "v", p) for i, p in enumerate(LINEAR)]
    + [Quantile(f"i{i}", "v", p, method="index") for i, p in enumerate(INDEX)]
    + [Quantile("s", "v", 0.5, strict=True)]
)


def check(df, data):
    got = {r.k: r for r in df.collect()}
    groups = {}
    for k, v in data:
        groups.setdefault(k, []).append(v)
    assert set(got) == set(groups)
    for k, values in groups.items():
        assert got[k].n == len(values)
        for i, p in enumerate(LINEAR):
            want = linear(values, p)
            assert got[k][f"l{i}"] == (want if want is None else pytest.approx(want, rel=1e-12, abs=1e-12)), (k, p)
        for i, p in enumerate(INDEX):
            assert got[k][f"i{i}"] == by_index(values, p), (k, p)
        want = None if None in values else linear(values, 0.5)
        assert got[k].s == (want if want is None else pytest.approx(want, rel=1e-12)), k


@pytest.mark.parametrize("tasks", [1, 3, 40])
def test_against_brute_force(spark, tasks):
    data = rows()
    df = spark.createDataFrame(data, "k int, v double").repartition(5)
    check(summarise(df, ["k"], [F.count(F.lit(1)).alias("n")], QUANTILES, tasks), data)


def test_two_key_columns_and_null_keys(spark):
    data = [(a, b, float(i % 17)) for i in range(400) for a, b in [(1, "x"), (1, "y")]] + [(None, "x", 1.0)]
    df = spark.createDataFrame(data, "a int, b string, v double")
    out = summarise(df, ["a", "b"], [F.count(F.lit(1)).alias("n")], [Quantile("m", "v", 0.5)], 5).collect()
    want = float(np.median([i % 17 for i in range(400)]))
    assert sorted(tuple(r) for r in out) == [(1, "x", 400, want), (1, "y", 400, want)]


def test_values_are_counted_before_they_are_shuffled(spark):
    """One hot key with few values: what the ranges hold is values, not rows, and no group is gathered."""
    df = spark.range(20_000, numPartitions=4).select(F.lit(1).alias("k"), (F.col("id") % 50).cast("double").alias("v"))
    out = summarise(df, ["k"], [F.count(F.lit(1)).alias("n")], [Quantile("m", "v", 0.25), Quantile("i", "v", 0.9, method="index")], 6)
    assert [tuple(r) for r in out.collect()] == [(1, 20_000, 12.0, 45.0)]
    plan = out._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "percentile(" not in plan
