import pytest
import pandas as pd
from pyspark.sql import functions as F

from zoneflow.operators import agg


@pytest.fixture(scope="module")
def generated(spark):
    return agg.generate_zone_fare(spark, 50_000, 16)


def test_generated_table(spark, generated):
    assert generated.dtypes == [("zone", "int"), ("fare", "double")]
    assert generated.rdd.getNumPartitions() == 16
    first = [tuple(r) for r in agg.generate_zone_fare(spark, 300, 1).collect()]
    assert first == [(i % 265, (i * 7919 % 10000) / 100.0) for i in range(300)]


def test_all_methods_agree(generated):
    out = agg.agreement({n: m(generated) for n, m in agg.METHODS.items()})
    assert tuple(agg.totals_check(out).first()) == (265, 50_000, True)
    assert {r.n_methods for r in out.collect()} == {5}


def test_disagreement_is_reported(generated):
    good = agg.by_builtin(generated)
    worse = good.withColumn("n", F.when(F.col("zone") == 3, F.col("n") + 1).otherwise(F.col("n")))
    missing = good.filter("zone <> 4")
    bad = {r.zone for r in agg.agreement({"a": good, "b": worse, "c": missing}).filter("NOT agree").collect()}
    assert bad == {3, 4}


def test_hot_zone_is_sliced(spark):
    df = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).cast("int").alias("zone"),
        F.when(F.col("id") % 11 != 0, F.col("id") / 4).alias("fare"),
    )
    want = sorted((r.zone, r.n, round(r.avg_fare, 9)) for r in agg.by_builtin(df).collect())
    sliced = agg.by_frame(df, max_frame=100)
    assert sorted((r.zone, r.n, round(r.avg_fare, 9)) for r in sliced.collect()) == want
    for name, method in agg.METHODS.items():
        assert sorted((r.zone, r.n, round(r.avg_fare, 9)) for r in method(df).collect()) == want, name


def test_distinct_keys_in_order(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (2,)], "k int")
    assert [r.k for r in agg.distinct_keys(df, "k").collect()] == [1, 2, 3]


def test_builtin_aggregates_before_the_shuffle(generated):
    plan = agg.by_builtin(generated)._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan


def test_frames_have_a_bound_also_for_grouped_input(spark):
    """All rows of a hot key in one partition, as after a repartition by key."""
    df = spark.range(10_000).selectExpr("case when id < 9000 then 1 else cast(id % 7 as int) + 2 end as zone", "cast(id as double) as fare")
    df = df.selectExpr("cast(zone as int) as zone", "fare").repartition(4, "zone")
    out = agg.grouped_map(
        df, ["zone"], lambda key, frame: pd.DataFrame({"zone": [key[0]], "n": [len(frame)]}), "zone int, n long", max_frame=1000
    ).collect()
    hot = [r.n for r in out if r.zone == 1]
    assert sum(hot) == 9000 and max(hot) < 1300 and len(hot) == 9
    assert sorted(r.n for r in out if r.zone != 1) == sorted(
        r["count"] for r in df.filter("zone <> 1").groupBy("zone").count().collect()
    )


def test_grouped_map_takes_any_function(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 4.0), ("b", 2, 1.0), (None, 2, 9.0)], "k string, j int, v double")
    top = lambda key, frame: frame.nlargest(1, "v")[["k", "j", "v"]]
    out = agg.grouped_map(df, ["k", "j"], top, "k string, j int, v double").collect()
    assert sorted(tuple(r) for r in out) == [("a", 1, 4.0), ("b", 2, 1.0)]
