"""Places, exact samples, folds by place, heavy keys and table comparison against plain versions."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from zoneflow.operators import compare, heavy, sampling
from zoneflow.operators.places import with_places


@pytest.mark.parametrize("tasks", [1, 4, 25])
def test_places_of_hot_null_and_repeated_keys(spark, tasks):
    r = random.Random(tasks)
    rows = [(r.choice([7, 7, 7, None, 1, 2]), r.choice("abc"), r.randrange(50), r.randrange(1, 5)) for _ in range(600)]
    df = spark.createDataFrame(rows, "k int, g string, v int, w long").repartition(6)
    for weight in (None, "w"):
        got = [tuple(x) for x in with_places(df, ["k", "g"], ["v", "w"], "p", weight, tasks).collect()]
        want, before = [], collections.Counter()
        for k, g, v, w in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, *x[1:])):
            want.append((k, g, v, w, before[k, g]))
            before[k, g] += w if weight else 1
        assert sorted(got, key=str) == sorted(want, key=str)


def test_places_in_the_whole_table(spark):
    df = spark.range(1000, numPartitions=7).select((F.col("id") * 7919 % 1000).alias("v"))
    assert sorted((x.v, x.p) for x in with_places(df, [], ["v"], "p", tasks=5).collect()) == [(i, i) for i in range(1000)]
    assert with_places(df.limit(0), [], ["v"], "p").collect() == []
    assert with_places(df.limit(0), ["v"], [], "p").collect() == []


def test_exact_sample(spark):
    df = spark.range(5000, numPartitions=5).select((F.col("id") % 4000).alias("k"), F.lit("x").alias("__h_other"))
    samples = {n: [x.k for x in sampling.sample_exactly(df, ["k"], n).collect()] for n in (0, 1, 777, 4999, 5000, 6000)}
    assert {n: len(s) for n, s in samples.items()} == {0: 0, 1: 1, 777: 777, 4999: 4999, 5000: 5000, 6000: 5000}
    assert not collections.Counter(samples[777]) - collections.Counter(samples[4999])
    other = sampling.sample_exactly(df.repartition(3), ["k"], 777).collect()
    assert sorted(x.k for x in other) == sorted(samples[777])
    same = spark.range(100).select(F.lit(1).alias("k"))
    assert sampling.sample_exactly(same, ["k"], 30).count() == 30


def test_folds_by_place(spark):
    df = spark.range(1003).select((F.col("id") * 37 % 1003).alias("v"))
    got = {x.v: x.fold for x in sampling.with_folds_by_place(df, ["v"], 5).collect()}
    assert got == {v: v % 5 for v in range(1003)}


@pytest.mark.parametrize("counters", [2, 40, 4096])
def test_heavy_keys(spark, counters):
    r = random.Random(counters)
    rows = [(r.choice([0] * 30 + [1] * 10 + [None] * 5 + list(range(2, 300))), r.choice("ab")) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k int, g string").repartition(6)
    want = collections.Counter(x for x in rows if x[0] is not None)
    total = sum(want.values())
    got = {(x.k, x.g): x.n for x in heavy.heavy_keys(df, ["k", "g"], min_rows=30, counters=counters).collect()}
    assert got == {k: n for k, n in want.items() if n >= 30}
    got = {(x.k, x.g): x.n for x in heavy.heavy_keys(df, ["k", "g"], share=0.02, counters=counters).collect()}
    assert got == {k: n for k, n in want.items() if n >= 0.02 * total} and got
    assert heavy.heavy_keys(df.limit(0), ["k"], share=0.1).collect() == []


def test_hot_key_is_split(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 3, 0).otherwise(F.col("id") % 500 + 1).alias("k"), "id")
    rows = heavy.repartition_split(df, "k", 16).withColumn("c", F.spark_partition_id()).collect()
    sizes = collections.Counter(x.c for x in rows)
    assert len(rows) == 20_000 and len({x.id for x in rows}) == 20_000 and len(sizes) == 16
    assert max(sizes.values()) <= 2 * 20_000 / 16
    chunks = collections.defaultdict(set)
    for x in rows:
        chunks[x.k].add(x.c)
    assert len(chunks[0]) == 10 and all(len(c) == 1 for k, c in chunks.items() if k)


def test_differing_rows(spark):
    rows = [(i % 50, None if i % 7 == 0 else f"t{i % 50}") for i in range(2000)]
    a = spark.createDataFrame(rows, "k int, t string")
    assert compare.differing_rows(a, a.repartition(3).select("t", "k", F.lit(1).alias("more"))).collect() == []
    changed = spark.createDataFrame([*rows[:-1], (49, "else")], "k int, t string")
    lost = rows[-1]
    got = sorted(((x.k, x.t, x.n_left, x.n_right) for x in compare.differing_rows(a, changed).collect()), key=str)
    n = collections.Counter(rows)[lost]
    assert got == sorted([(*lost, n, n - 1), (49, "else", 0, 1)], key=str)
    twice = a.unionAll(a.limit(1)).unionAll(a.limit(1))  # two equal rows, which an exclusive or would not see
    assert [(x.n_right - x.n_left) for x in compare.differing_rows(a, twice).collect()] == [2]
    assert len(compare.differing_rows(a, a.limit(0)).collect()) == len(set(rows))
