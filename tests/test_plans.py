"""Plans of the main queries: pruned columns, pushed filters, broadcast joins."""

import io
from contextlib import redirect_stdout

from conftest import SF_SMALL

from zoneflow.operators import matrix
from zoneflow.plans import queries, tables


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_matrix_scan_is_pruned_and_filtered(spark):
    p = plan(matrix.model_matrix(tables.trips(spark, SF_SMALL), *tables.WINDOW))
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p
    assert "GreaterThan(l_extendedprice,0.0)" in p
    for unused in ("l_orderkey", "l_comment", "l_returnflag", "l_discount"):
        assert f"{unused}:" not in p


def test_features_join_is_broadcast_and_combined(spark):
    p = plan(queries.QUERIES["zone_features"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "partial_percentile" in p  # the other aggregates are stored with the groups' sizes
    assert "n_name:" not in p and "s_name:" not in p


def test_count_reads_no_column(spark):
    p = plan(matrix.matrix_profile(tables.trips(spark, SF_SMALL), *tables.WINDOW))
    assert "ReadSchema: struct<>" in p


def test_no_cross_joins(spark):
    for name in ("grid_scores", "matrix_profile", "kfold_train_stats", "five_way_agreement"):
        p = plan(queries.QUERIES[name](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_inventory_does_not_read_contents(spark):
    from zoneflow.sources import files

    p = plan(files.file_inventory(spark, f"{SF_SMALL}/*.parquet"))
    assert "ReadSchema: struct<path:string,length:bigint>" in p


def test_quantiles_read_the_source_twice_and_loop_never(spark, tmp_path):
    """Once for the aggregates, once for the counts of values; range partitioning samples the counts, not the source."""
    from pyspark.sql import functions as F

    from zoneflow.operators.quantiles import Quantile, summarise

    path = str(tmp_path / "rows")
    spark.range(4000).select((F.col("id") % 3 * (F.col("id") % 2)).alias("k"), F.rand(3).alias("v")).write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        reads.add(1)
        yield from batches

    df = spark.read.parquet(path).coalesce(1).mapInArrow(seen, "k long, v double")
    out = summarise(df, ["k"], [F.count(F.lit(1)).alias("n")], [Quantile("q", "v", 0.9), Quantile("m", "v", 0.5)], 9)
    assert out.count() == 3 and sum(r.n for r in out.collect()) == 4000
    assert reads.value <= 3  # the sample of the ranges may ask for the counts once more
