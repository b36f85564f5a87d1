import pytest
from pyspark.sql import functions as F

from zoneflow.functions import exprs
from zoneflow.operators import ledger, runlog

ROWS = [
    ("1_duckdb", "i-1", 1, "scan", 40.0, None, "m7g"),
    ("2_emr", "j-1", 2, "A_aggregate", 118.0, 412.0, "m7g"),
    ("2_emr", "j-1", 2, "B_fit", 60.0, None, "m7g"),
    ("2_emr", "j-1", 4, "A_aggregate", 80.0, None, "m7g"),
    ("2_emr", "j-1", 4, "B_fit", 30.0, None, "m7g"),
]
SCHEMA = "stage string, resource_id string, nodes int, phase string, wall_s double, startup_s double, instance_type string"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_compare(spark, rows):
    predicted = spark.createDataFrame(
        [("2_emr", "A_aggregate", 2, 100.0), ("2_emr", "A_aggregate", 4, 50.0), ("2_emr", "B_fit", 2, 55.0),
         ("2_emr", "B_fit", 4, 27.5), ("3_other", "scan", 1, 1.0)],
        "stage string, phase string, nodes int, predicted_s double",
    )
    out = {r.phase: r for r in ledger.compare_nodes(ledger.with_predictions(rows, predicted), ["phase"]).collect()}
    assert set(out) == {"A_aggregate", "B_fit", "scan"}
    assert out["scan"].predicted_small_s is None and (out["B_fit"].n_small, out["B_fit"].n_large) == (1, 1)
    a = out["A_aggregate"]
    assert (a.predicted_small_s, a.predicted_large_s, a.wall_small_s, a.wall_large_s) == (100.0, 50.0, 118.0, 80.0)
    assert a.speedup == 118 / 80 and out["B_fit"].speedup == 2.0


def test_complete(spark, rows):
    one = rows.withColumn("resource_id", F.lit("x"))
    assert tuple(ledger.ledger_complete(one).first()) == ("x", 5, True, True)
    assert tuple(ledger.ledger_complete(one.limit(4)).first()) == ("x", 4, True, False)
    assert tuple(ledger.ledger_complete(one.union(one)).first()) == ("x", 10, False, False)


def test_cost(spark, rows):
    prices = spark.createDataFrame([("m7g", 0.36)], "instance_type string, rate_usd double")
    got = {(r.phase, r.nodes): r.cost_usd for r in ledger.with_cost(rows, prices).collect()}
    assert got[("scan", 1)] == pytest.approx(40 / 3600 * 0.36)
    assert got[("A_aggregate", 2)] == pytest.approx((118 + 412) / 3600 * 0.36 * 3)
    assert got[("B_fit", 4)] == pytest.approx(30 / 3600 * 0.36 * 5)
    unpriced = ledger.with_cost(rows, prices.limit(0)).collect()
    assert len(unpriced) == len(ROWS) and all(r.cost_usd is None for r in unpriced)


def test_unpredicted_rows_stay(spark, rows):
    none = spark.createDataFrame([], "stage string, phase string, nodes int, predicted_s double")
    out = ledger.with_predictions(rows, none).collect()
    assert len(out) == len(ROWS) and all(r.predicted_s is None for r in out)


def test_seconds_per_fit(spark):
    text = "===A2-METRICS v2.0 phase=B_fit===\nwall_s=30\nfits_done=60\neffective_parallelism=8\n===END===\n"
    text += "===A2-METRICS v2.0 phase=A_aggregate===\nwall_s=30\n===END===\n"
    blocks = runlog.parse_blocks(spark.createDataFrame([("p", text)], "path string, text string"))
    assert [tuple(r) for r in ledger.seconds_per_fit(blocks).collect()] == [("p", 4.0)]


def test_scalar_expressions(spark):
    df = spark.createDataFrame([(None, 2.0), (0.5, None), (3.0, 0.0)], "a double, b double")
    out = df.select(exprs.at_least(F.col("a"), 1.0), exprs.at_most(F.col("a"), 1.0), exprs.ratio(F.col("a"), F.col("b"), 0.1))
    assert [tuple(r) for r in out.collect()] == [(None, None, None), (1.0, 0.5, None), (3.0, 1.0, 30.0)]
    t = spark.sql("SELECT timestamp_ntz'2025-01-01 00:00:00' AS a, timestamp_ntz'2025-01-01 00:06:52.5' AS b")
    assert t.select(exprs.seconds_between(F.col("a"), F.col("b"))).first()[0] == 412.5
    r = spark.range(1).select(exprs.megabytes_per_second(F.lit(604e6), F.lit(1.0), 4), exprs.megabytes_per_second(F.lit(1e6), F.lit(0.0)))
    assert tuple(r.first()) == (151.0, 1e9)
