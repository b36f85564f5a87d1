import math

import pytest
from pyspark.sql import functions as F

from zoneflow.operators import features as ft
from zoneflow.operators.matrix import TAXI

SCHEMA = "PULocationID int, fare_amount double, tip_amount double, trip_distance double"
NULL_MATRIX = [
    (1, 10.0, 2.0, 1.0), (1, 20.0, None, 2.0), (2, 5.0, 1.0, None), (2, None, 1.0, 4.0), (3, 0.0, 1.0, 0.05), (3, 8.0, 2.0, 3.0),
]
EXPECTED = {
    1: (2, 15.0, None, 1.9, 10.0),
    2: (2, 5.0, None, None, None),
    3: (2, 4.0, 50.125, 2.705, 1.3333333333333333),
}


def as_dict(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def same(got, want):
    assert set(got) == set(want)
    for k in want:
        for g, w in zip(got[k], want[k]):
            assert g is None if w is None else g == pytest.approx(w, rel=1e-12), k


@pytest.mark.parametrize("tasks", [1, 20])
@pytest.mark.parametrize("nan", [False, True])
def test_null_matrix(spark, tasks, nan):
    gap = lambda v: math.nan if nan and v is None else v
    df = spark.createDataFrame([tuple(gap(v) for v in r) for r in NULL_MATRIX], SCHEMA)
    same(as_dict(ft.zone_features(df, tasks=tasks)), EXPECTED)
    same(as_dict(ft.zone_features_grouped(df)), EXPECTED)
    same(as_dict(ft.zone_features_grouped(df, max_frame=1)), EXPECTED)


def test_single_row_all_null_and_empty(spark):
    df = spark.createDataFrame([(1, 10.0, 1.0, 2.0), (2, None, None, None), (None, 1.0, 1.0, 1.0)], SCHEMA)
    want = {1: (1, 10.0, 0.1, 2.0, 5.0), 2: (1, None, None, None, None)}
    same(as_dict(ft.zone_features(df)), want)
    same(as_dict(ft.zone_features_grouped(df)), want)
    empty = df.limit(0)
    assert ft.zone_features(empty).collect() == [] and ft.zone_features_grouped(empty).collect() == []


def test_result_schema(spark):
    df = ft.zone_features(spark.createDataFrame(NULL_MATRIX, SCHEMA))
    assert [t for _, t in df.dtypes] == ["int", "bigint", "double", "double", "double", "double"]
    assert df.columns[0] == TAXI.zone


def test_large_group_split_between_frames_and_builtin(spark):
    rows = [(i % 3 if i % 2 else 0, float(i % 50 + 1), float(i % 7), float(i % 23 + 1)) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = as_dict(ft.zone_features(df))
    same(as_dict(ft.zone_features_grouped(df, max_frame=150)), want)
    same(as_dict(ft.zone_features(df, tasks=30)), want)


def test_lookup_join_keeps_unmatched_and_reports_duplicates(spark):
    trips = spark.createDataFrame([(1,), (2,), (9,)], "PULocationID int")
    lookup = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "LocationID int, Zone string")
    out = ft.lookup_join(trips, lookup, "PULocationID", "LocationID")
    assert sorted((r.PULocationID, r.Zone or "") for r in out.collect()) == [(1, "a"), (2, "b"), (2, "c"), (9, "")]
    assert [tuple(r) for r in ft.duplicate_keys(lookup, ["LocationID"]).collect()] == [(2, 2)]
    assert tuple(ft.key_uniqueness(lookup, ["LocationID"]).first()) == (2, 1, False)


def test_broadcast_only_below_the_measured_size(spark):
    trips = spark.range(1000).select(F.col("id").cast("int").alias("k"))
    lookup = spark.range(100).select(F.col("id").cast("int").alias("z"), F.repeat(F.lit("x"), 1000).alias("name"))
    hinted = lambda d: "strategy=broadcast" in d._jdf.queryExecution().logical().toString()
    assert hinted(ft.lookup_join(trips, lookup, "k", "z"))
    beyond = ft.lookup_join(trips, lookup, "k", "z", max_bytes=10_000)
    assert not hinted(beyond) and beyond.count() == 1000


def test_key_skew(spark):
    df = spark.createDataFrame([(1,)] * 6 + [(2,)] * 3 + [(3,)], "k int")
    assert tuple(ft.key_skew(df, "k").first()) == (10, 3, 6, 0.6)


def test_repartition_by_key(spark):
    df = ft.repartition_by_key(spark.range(100).select((F.col("id") % 5).alias("k")), "k", 16)
    parts = df.select("k", F.spark_partition_id().alias("p")).distinct().groupBy("k").count()
    assert df.rdd.getNumPartitions() == 16
    assert {r["count"] for r in parts.collect()} == {1}
