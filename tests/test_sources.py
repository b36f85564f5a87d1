import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from zoneflow.sources import files, logs, workdir


@pytest.fixture()
def drift(tmp_path):
    a = pa.table({"loc": pa.array([1, 2], pa.int64()), "pc": pa.array([1.5, None], pa.float64()), "fee": [1.0, 2.0]})
    b = pa.table(
        {"loc": pa.array([3], pa.int32()), "pc": pa.array([4], pa.int64()), "Fee": [9.0], "extra": ["x"]}
    )
    pq.write_table(a, tmp_path / "a.parquet")
    pq.write_table(a, tmp_path / "a2.parquet")
    pq.write_table(b, tmp_path / "b.parquet")
    return str(tmp_path)


def test_union_by_name_widens_ignores_case_fills(spark, drift):
    df = files.read_union_by_name(spark, f"{drift}/*.parquet")
    assert [c.lower() for c in df.columns] == ["loc", "pc", "fee", "extra"]
    assert [t for _, t in df.dtypes] == ["bigint", "double", "double", "string"]
    got = sorted(tuple(r) for r in df.collect() if r.pc is not None)
    assert got == [(1, 1.5, 1.0, None), (1, 1.5, 1.0, None), (3, 4.0, 9.0, "x")]
    assert df.count() == 5


def test_one_scan_per_schema(spark, drift):
    plan = files.read_union_by_name(spark, f"{drift}/*.parquet")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


@pytest.mark.parametrize("second", [pa.int64(), pa.int32()])
def test_folder_columns_stay_when_schemas_drift(spark, tmp_path, second):
    for year, kind in ((1, pa.int64()), (2, second)):
        (tmp_path / f"year={year}").mkdir()
        pq.write_table(pa.table({"x": pa.array([year], kind)}), tmp_path / f"year={year}" / "p.parquet")
    for path in (str(tmp_path), f"{tmp_path}/*"):
        out = files.read_union_by_name(spark, path)
        if path == str(tmp_path):
            assert sorted((r.x, r.year) for r in out.collect()) == [(1, 1), (2, 2)]
        assert sorted(r.x for r in out.collect()) == [1, 2]


def test_base_path():
    assert files.base_path("s3://b/raw/x_*.parquet") == "s3://b/raw"
    assert files.base_path("/a/year=*/m=1/p.parquet") == "/a"
    assert files.base_path("/a/b") == "/a/b" and files.base_path("/a/b/p.parquet") == "/a/b"


def test_contract(spark, drift):
    contract = T.StructType([T.StructField("LOC", T.IntegerType()), T.StructField("tip", T.DoubleType())])
    df = files.read_union_by_name(spark, f"{drift}/*.parquet", contract)
    assert df.dtypes == [("LOC", "int"), ("tip", "double")]
    assert sorted(r.LOC for r in df.collect()) == [1, 1, 2, 2, 3]


def test_inventory_and_footers(spark, drift):
    inv = files.file_inventory(spark, f"{drift}/*.parquet")
    assert "content" not in inv.columns
    totals = files.inventory_totals(inv, expected_files=3).first()
    assert totals.n_files == 3 and totals.complete and totals.total_bytes > 0
    assert not files.inventory_totals(inv, expected_files=40).first().complete
    rows = files.footers(spark, f"{drift}/*.parquet")
    metas = [pq.read_metadata(f"{drift}/{n}.parquet") for n in ("a", "a2", "b")]
    want = sum(m.row_group(0).column(i).total_compressed_size for m in metas for i in range(m.num_columns))
    got = files.byte_totals(rows, ["loc"]).first()
    loc = sum(m.row_group(0).column(0).total_compressed_size for m in metas)
    assert (got.bytes_on_disk, got.bytes_needed) == (want, loc)
    per_column = {r.path_in_schema: (r.compressed_bytes, r.needed) for r in files.column_footprint(rows, ["loc"]).collect()}
    assert per_column["loc"] == (loc, True) and not per_column["extra"][1]


def test_csv_to_parquet(spark, tmp_path):
    (tmp_path / "zones.csv").write_text('LocationID,Borough,Zone,service\n1,EWR,"Newark, Airport",x\n2,Queens,Jamaica,y\n')
    out = files.csv_to_parquet(spark, str(tmp_path / "zones.csv"), str(tmp_path / "out"), ["LocationID", "Borough", "Zone"])
    assert out.dtypes == [("LocationID", "int"), ("Borough", "string"), ("Zone", "string")]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "EWR", "Newark, Airport"), (2, "Queens", "Jamaica")]


def test_materialise_cuts_lineage_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    workdir.materialise(spark.range(5).toDF("x"), path)
    df = workdir.materialise(spark.range(3).toDF("x"), path)
    assert df.count() == 3
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_work_root_reads_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert workdir.new_path(spark, "t").startswith(f"{root}/t-")


def test_no_machine_local_folder_on_a_cluster():
    class Unset:
        master, applicationId = "yarn", "app"
        conf = property(lambda self: self)
        sparkContext = property(lambda self: self)

        def get(self, key, default):
            return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workdir.work_root(Unset())


def test_pinned_partitions(spark):
    df = lambda: spark.range(1000).selectExpr("id % 50 AS k").groupBy("k").count()
    with workdir.pinned_partitions(spark, 16):
        pinned = df()
        pinned.collect()
        assert pinned.rdd.getNumPartitions() == 16
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert df().rdd.getNumPartitions() < 16


def test_cached_is_released(spark):
    with workdir.cached(spark.range(10).toDF("x")) as df:
        assert df.is_cached and df.count() == 10
    assert not df.is_cached


def test_row_groups_outside_a_window_need_not_be_read(spark, tmp_path):
    import datetime as dt

    import pyarrow as pa
    import pyarrow.parquet as pq

    day = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(days=i)
    pq.write_table(pa.table({"at": [day(i) for i in range(100)], "x": list(range(100))}), tmp_path / "a.parquet", row_group_size=10)
    pq.write_table(pa.table({"at": pa.array([None, None], pa.timestamp("us")), "x": [1, 2]}), tmp_path / "b.parquet")
    pq.write_table(pa.table({"x": [1, 2, 3]}), tmp_path / "c.parquet")
    ranges = files.row_group_ranges(spark, str(tmp_path), "at", ["at"])
    got = files.surviving_bytes(ranges, "2024-01-15", "2024-01-31").first()
    # ten days a group: the second and third hold the window; groups without bounds are kept
    assert (got.n_groups, got.n_kept) == (12, 4)
    assert 0 < got.bytes_kept < got.bytes_needed < got.bytes_on_disk
    assert files.surviving_bytes(ranges.limit(0), "2024-01-15", "2024-01-31").first().n_groups == 0


def test_event_log_text_is_read_once(spark, tmp_path):
    folder = tmp_path / "eventlog_v2_a"
    folder.mkdir()
    (folder / "events_1_a").write_text('{"Event":"SparkListenerApplicationStart","App ID":"a","App Attempt ID":"1"}\n')
    (folder / "events_2_a").write_text('{"Event":"SparkListenerJobStart","Job ID":7}\n')
    (folder / "appstatus_a").write_text("")
    events = logs.read_event_log(spark, str(tmp_path))
    # the text is parsed before the events are told apart, not once more for each reader
    assert "Format: JSON" not in events._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.part, r.app_id, r.attempt, r["Job ID"]) for r in events.collect()) == [(1, "a", "1", None), (2, "a", "1", 7)]


def test_named_events_are_all_parsed(spark):
    lines = ['{"Event":"A","Job ID":1}', '{"Event":"B","Note":"A"}', '{"Event":"\\u0041","Job ID":2}', '{"Event":"C"}', None]
    df = spark.createDataFrame([(1, s) for s in lines], "run int, line string")
    assert sorted(r["Job ID"] for r in logs.parse_events(df, names=["A"]).collect()) == [1, 2]
