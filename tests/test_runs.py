"""Functions over whole groups in order, with groups that lie in many tasks."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from zoneflow.operators import runs


@pytest.mark.parametrize("tasks", [1, 30])
def test_longest_gaps(spark, tasks):
    r = random.Random(tasks)
    rows = [(r.choice([1, 1, 1, 1, 2, 3, None]), r.choice(["a", "b"]), r.choice([None, *range(1000)])) for _ in range(700)] + [(9, "a", 5), (8, "b", None)]
    df = spark.createDataFrame(rows, "k int, g string, at int").repartition(5)
    groups = collections.defaultdict(list)
    for k, g, at in rows:
        if k is not None and at is not None:
            groups[k, g].append(at)
    want = {}
    for key, v in groups.items():
        v.sort()
        want[key] = (len(v), max((float(b - a) for a, b in zip(v, v[1:])), default=None))
    assert {(x.k, x.g): (x.n, x.longest_gap) for x in runs.longest_gaps(df, ["k", "g"], "at", tasks).collect()} == want
    assert runs.longest_gaps(df.limit(0), ["k"], "at").collect() == []


def test_whole_groups_arrive_in_order(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"), F.lit("x").alias("other"))
    step = lambda state, frame: state + frame["v"].tolist()
    out = runs.fold_groups(df, ["k"], [F.desc("v")], list, step, lambda a, b: a + b, lambda s: (s,), "vs array<long>", 12)
    assert {r.k: r.vs for r in out.collect()} == {k: list(range(498 + k, -1, -2)) for k in (0, 1)}
