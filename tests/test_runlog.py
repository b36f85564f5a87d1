import gzip

import pytest
from pyspark.sql import functions as F

from zoneflow.functions.formats import LEDGER_COLUMNS
from zoneflow.operators import runlog
from zoneflow.plans import tables
from zoneflow.plans.queries import QUERIES
from zoneflow.sources import logs, workdir


def block(body, head="mode=rest platform=emr stage=2_emr phase=A_aggregate"):
    return f"===A2-METRICS v2.0 {head}===\n{body}\n===END==="


BASE = {"listener_version": "2.0", "mode": "rest", "platform": "emr", "stage": "2_emr", "phase": "A_aggregate"}

# text -> expected blocks
CASES = {
    "none": ("nothing here\nk=v\n", []),
    "one": (f"noise\n{block('wall_s=1.5')}\nmore=1\n", [BASE | {"wall_s": "1.5"}]),
    "two": (f"{block('a=1')}\n{block('a=2', 'phase=B_fit')}\n",
            [BASE | {"a": "1"}, {"listener_version": "2.0", "phase": "B_fit", "a": "2"}]),
    "wrapped": (block("a=1\nWARN wrapped line\nb=2") + "\n", [BASE | {"a": "1", "b": "2"}]),
    "duplicate": (block("a=1\na=2") + "\n", [BASE | {"a": "2"}]),
    "equals": (block("note=x=y=z\nempty=") + "\n", [BASE | {"note": "x=y=z", "empty": ""}]),
    "override": (block("mode=degraded") + "\n", [BASE | {"mode": "degraded"}]),
    "truncated": (block("a=1").replace("\n===END===", "\n"), []),
    "cut then whole": (f"===A2-METRICS v2.0 phase=X===\na=1\n{block('b=2')}\n",
                       [{"listener_version": "2.0", "phase": "X", "a": "1", "b": "2",
                         "": "==A2-METRICS v2.0 mode=rest platform=emr stage=2_emr phase=A_aggregate==="}]),
    "last line without newline": (block("a=1"), [BASE | {"a": "1"}]),
    "blank body": (block(""), [BASE]),
    "carriage returns": (block("a=1\r\nb=2"), [BASE | {"a": "1", "b": "2"}]),
    "blanks": (block("  a=1  \n b = 2\t"), [BASE | {"a": "1  ", " b ": " 2"}]),
    "wide": (block("été=東京 z=9"), [BASE | {"été": "東京", "z": "9"}]),
    "version": (block("a=1").replace("v2.0", "v10.2.1"), [BASE | {"listener_version": "10.2.1", "a": "1"}]),
    "open after closed": (f"{block('a=1')}\n===A2-METRICS v2.0 phase=Y===\nb=1\n", [BASE | {"a": "1"}]),
}


@pytest.mark.parametrize("name", CASES)
def test_parse_text(spark, name):
    text, want = CASES[name]
    df = runlog.parse_blocks(spark.createDataFrame([("p", text)], "path string, text string"))
    assert [r.kv for r in df.orderBy("block").collect()] == want


def test_sections_of_files_parse_like_whole_files(spark, tmp_path):
    for name, (text, _) in CASES.items():
        (tmp_path / f"{name.replace(' ', '_')}.log").write_bytes(text.encode())
    sections = logs.read_log_sections(spark, str(tmp_path))
    by_section = runlog.parse_blocks(sections, keep=["path", "start", "seq"])
    got = {}
    for r in by_section.orderBy("path", "start", "seq", "block").collect():
        got.setdefault(r.path.split("/")[-1].removesuffix(".log").replace("_", " ").replace("%20", " "), []).append(r.kv)
    assert got == {name: want for name, (_, want) in CASES.items() if want}


def test_plain_log_text_is_not_kept(spark, tmp_path):
    (tmp_path / "plain.log").write_text("nothing here\n" * 100_000)
    (tmp_path / "late.log").write_text("noise\n" * 100_000 + block("a=1"))
    sections = logs.read_log_sections(spark, str(tmp_path)).collect()
    assert [r.text for r in sections] == [block("a=1")]


def test_large_log_is_split_over_tasks(spark, tmp_path):
    n = 3000
    (tmp_path / "big.log").write_text("".join(f"noise {i}\n{block(f'i={i}')}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        sections = logs.read_log_sections(spark, str(tmp_path))
        assert sections.rdd.getNumPartitions() > 5
        out = runlog.parse_blocks(sections, keep=["path", "start", "seq"])
        rows = out.orderBy("start", "seq").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [int(r.kv["i"]) for r in rows] == list(range(n))


def test_format_then_parse_is_the_identity(spark):
    head = {"mode": "rest", "phase": "B_fit"}
    body = {"wall_s": "12.5", "tasks": "7", "note": "a=b c", "none": "None"}
    lit = lambda d: {k: F.lit(None) if v == "None" else F.lit(v) for k, v in d.items()}
    df = spark.range(1).select(F.lit("p").alias("path"), runlog.block_text(lit(head), lit(body)).alias("text"))
    assert df.first().text == "===A2-METRICS v2.0 mode=rest phase=B_fit===\nwall_s=12.5\ntasks=7\nnote=a=b c\nnone=None\n===END==="
    assert runlog.parse_blocks(df).first().kv == {"listener_version": "2.0", **head, **body}


def test_ledger_rows_lines_and_file(spark, tmp_path):
    text = block("wall_s=9.1\nshuffle_write_bytes=10\ntask_min_s=0.1\ntask_med_s=0.2\ntask_max_s=0.3\nother=1")
    scan = block("wall_s=4", "stage=1_duckdb phase=scan mode=duckdb")
    blocks = runlog.parse_blocks(spark.createDataFrame([("a", text), ("b", scan)], "path string, text string"))
    rows = runlog.ledger_rows(blocks, "j-1", 2, 412)
    assert rows.columns == LEDGER_COLUMNS
    lines = [r.line for r in runlog.ledger_lines(rows).collect()]
    assert sorted(lines) == ["1_duckdb,j-1,2,scan,,4,412,,,,,", "2_emr,j-1,2,A_aggregate,,9.1,412,10,0.1,0.2,0.3,"]
    runlog.write_ledger(rows, str(tmp_path / "ledger"))
    stored = "".join(p.read_text() for p in sorted((tmp_path / "ledger").glob("part-*")))
    assert set(lines) < set(stored.splitlines())
    back = {r.stage: r for r in runlog.read_ledger(spark, str(tmp_path / "ledger")).collect()}
    assert back["2_emr"].task_max_s == "0.3" and back["2_emr"].cost_usd is None


def test_line_counts_and_prefixes(spark, tmp_path):
    (tmp_path / "a.log").write_text("RESULT x\nINFO Registered executor 1\nINFO Registered executor 2\n" + "DRIVER " + "y" * 400 + "\n")
    lines = logs.read_log_lines(spark, str(tmp_path))
    assert runlog.executor_counts(lines).first().n_executors == 2
    kept = sorted(r.line for r in runlog.lines_with_prefix(lines, ["RESULT", "DRIVER"]).collect())
    assert [len(x) for x in kept] == [407, 8]
    cut = sorted(r.line for r in runlog.lines_with_prefix(lines, ["RESULT", "DRIVER"], display_width=260).collect())
    assert [len(x) for x in cut] == [260, 8]


GOOD = "rest_target=advertised\nretried=0\nshuffle_partitions=16\n"
SCAN = "mode=duckdb stage=1_duckdb phase=scan"
RUNS = {
    # path: (text, checks that fail)
    "good": (block(GOOD + "partitions=16") + "\n" + block(GOOD + "partitions=60", "mode=rest phase=B_fit"), set()),
    "one block": (block(GOOD + "partitions=16"), {"blocks_ok"}),
    "degraded": (block(GOOD + "partitions=16") + "\n" + block(GOOD + "mode=degraded", "mode=rest phase=B_fit"), {"mode_ok"}),
    "no target": (block(GOOD + "partitions=16\nrest_target=none") + "\n" + block(GOOD, "mode=rest phase=B_fit"), {"mode_ok"}),
    "retried": (block(GOOD + "partitions=16\nretried=1") + "\n" + block(GOOD, "mode=rest phase=B_fit"), {"retried_ok"}),
    "pin lost": (block(GOOD + "partitions=2") + "\n" + block(GOOD, "mode=rest phase=B_fit"), {"pin_ok"}),
    "scan": (block("bytes_on_disk=2000\nbytes_needed=900\nt_read_s=0.5", SCAN), set()),
    "scan empty": (block("bytes_on_disk=2000\nbytes_needed=0\nt_read_s=0.5", SCAN), {"bytes_ok"}),
    "scan all": (block("bytes_on_disk=2000\nbytes_needed=2000\nt_read_s=0.5", SCAN), {"bytes_ok"}),
    "scan too fast": (block("bytes_on_disk=9000000000\nbytes_needed=2000000000\nt_read_s=1", SCAN), {"rate_ok"}),
    "scan no time": (block("bytes_on_disk=2000\nbytes_needed=900", SCAN), {"rate_ok"}),
}


def checked(spark, runs, seen=None):
    """Checks of ``(path, nodes, pin)`` runs whose logs are named in RUNS, by path."""
    texts = [(p, RUNS[p][0] if p in RUNS else "started\nTraceback") for p, _, _ in runs]
    blocks = runlog.parse_blocks(spark.createDataFrame(texts, "path string, text string"))
    out = runlog.run_checks(spark.createDataFrame(runs, "path string, nodes long, pin double"), blocks, seen).collect()
    assert len(out) == len(runs)
    return {r.path: (r, {c for c in r.asDict() if c.endswith("_ok") and r[c] is False}) for r in out}


def test_run_checks(spark):
    for path, (r, failed) in checked(spark, [(p, None, None) for p in RUNS]).items():
        assert failed == RUNS[path][1], path
        assert r.valid == (not failed)


def test_a_log_without_blocks_is_a_failed_run(spark):
    r, failed = checked(spark, [("good", None, None), ("died", None, None)])["died"]
    assert r.n_blocks == 0 and failed == {"blocks_ok"} and not r.valid


def test_run_checks_with_executors(spark):
    seen = spark.createDataFrame([("good", 4), ("pin lost", 2)], "path string, n_executors long")
    runs = [("good", 4, None), ("retried", 4, None), ("scan", 1, None), ("pin lost", 2, None), ("one block", None, None)]
    out = checked(spark, runs, seen)
    assert out["good"][0].executors_ok and out["good"][0].valid
    assert out["retried"][1] == {"retried_ok", "executors_ok"}
    assert out["scan"][0].executors_ok is None and out["scan"][0].valid
    assert out["pin lost"][0].executors_ok and out["one block"][0].executors_ok is None


def test_the_pin_is_the_runs_own(spark):
    assert checked(spark, [("good", None, 8.0)])["good"][1] == {"pin_ok"}
    assert checked(spark, [("good", None, 16.0)])["good"][0].valid


def in_order(df):
    got = {}
    for r in runlog.parse_blocks(df, keep=["path", "start", "seq"]).orderBy("path", "start", "seq", "block").collect():
        got.setdefault(r.path.split("/")[-1].removesuffix(".log"), []).append(r.kv)
    return got


def test_blocks_over_many_splits(spark, tmp_path, monkeypatch):
    """Sections that begin in one split, run through others without any mark, and end, or never do, in a later one."""
    monkeypatch.setattr(logs, "PIECE_CHARS", 30)
    long = "\n".join(f"k{i}=v{i}\nplain {i}" for i in range(40))
    texts = {
        "spans": f"noise\n{block(long)}\nx=1\n{block('a=1', 'phase=B_fit')}\n",
        "inner": f"===A2-METRICS v2.0 phase=X===\n{long}\n{block('b=2')}\n{block('c=3')}\n",
        "open": f"{block('a=1')}\n===A2-METRICS v2.0 phase=Y===\n{long}\n",
        "orphan": f"{long}\n===END===\n{block('d=4')}===A2-METRICS v2.0 phase=Z===\n\n\n===END===",
        "plain": f"{long}\n" * 3,
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.log").write_text(text)
    whole = {n: [x + "\n===END===" for x in t.split("\n===END===")[:-1]] for n, t in texts.items()}
    rows = [(n, 0, i, x) for n, l in whole.items() for i, x in enumerate(l) if "===A2-METRICS" in x]
    want = in_order(spark.createDataFrame(rows, "path string, start int, seq int, text string"))
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {n: spark.conf.get(n) for n in names}
    try:
        for size in ("150", "128m"):
            spark.conf.set(names[0], size)
            spark.conf.set(names[1], "0")
            assert in_order(logs.read_log_sections(spark, str(tmp_path))) == want
    finally:
        for n, v in old.items():
            spark.conf.set(n, v)
    assert set(want) == {"spans", "inner", "open", "orphan"} and len(want["inner"]) == 2 and len(want["open"]) == 1


def test_blocks_are_not_parsed_by_nested_expressions(spark):
    df = runlog.parse_blocks(spark.createDataFrame([("p", CASES["two"][0])], "path string, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    # every step of such an expression was computed again for each step that read it
    assert "lambdafunction" not in plan and "substr" not in plan


def test_a_mark_without_a_version_is_no_block(spark):
    text = block("a=1\nb=2\na=3\nmode=x", "mode=rest v=1") + "===A2-METRICS vX mode=no===\nq=1\n===END===\n" + block("z=1", "h=1")
    rows = runlog.parse_blocks(spark.createDataFrame([("p", text), ("none", None)], "path string, text string")).orderBy("block").collect()
    assert [(r.path, r.block, r.kv) for r in rows] == [
        ("p", 0, {"mode": "x", "a": "3", "b": "2", "v": "1", "listener_version": "2.0"}),
        ("p", 1, {"z": "1", "h": "1", "listener_version": "2.0"}),
    ]


def test_stored_logs_are_small_beside_their_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workdir, "work_root", lambda _: str(tmp_path / "work"))
    n = 4000
    line_items = spark.range(n).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 97).alias("l_partkey"), (F.col("id") % 13).alias("l_suppkey"),
        (F.col("id") % 4 + 1).cast("int").alias("l_linenumber"), (F.col("id") % 50).cast("double").alias("l_quantity"),
        (F.col("id") * 7.5 + 900).alias("l_extendedprice"), (F.col("id") % 10 / 100).alias("l_discount"),
        F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
    )
    line_items.write.parquet(str(tmp_path / "sf/lineitem.parquet"))
    spark.createDataFrame([("plain\n",), (None,)], "text string").write.parquet(str(tmp_path / "sf/documents.parquet"))
    got = {(r.phase, r.mode): (r.n_blocks, r.sum_wall_s) for r in QUERIES["parse_log_files"](spark, str(tmp_path / "sf")).collect()}
    two, one = [i % 50 for i in range(n) if i % 2 == 0], [i % 50 for i in range(n) if i % 2]
    assert got == {
        ("A_aggregate", "rest"): (len(two), sum(two)), ("B_fit", "rest"): (len(two), sum(two) + 7 * len(two)), ("scan", "duckdb"): (len(one), sum(one))
    }
    text = tables.run_logs(spark, str(tmp_path / "sf")).agg(F.sum(F.octet_length("text"))).first()[0]
    stored = sum(p.stat().st_size for p in (tmp_path / "work").rglob("*") if p.is_file())
    assert stored < text / 4


def test_compressed_logs_read_whole_are_like_plain_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(logs, "PIECE_CHARS", 30)
    monkeypatch.setattr(logs, "UNPACKED_BYTES", 7)
    long = "\n".join(f"k{i}=été{i}\nplain {i}\n \n\x1c" for i in range(20))
    texts = {
        "two": f"noise\n{block(long)}\nx=1\n{block('a=1', 'phase=B_fit')}\n",
        "inner": f"===A2-METRICS v2.0 phase=X===\n{long}\n{block('b=2')}\n{block('c=3\r')}",
        "open": f"{block('a=1')}\n===A2-METRICS v2.0 phase=Y===\n{long}\n",
        "orphan": f"{long}\n===END===\n===END==={block('d=4')}===A2-METRICS v2.0 phase=Z===\n\n\n===END===\n",
        "empty": "",
        "lines": "\n\n\n",
    }
    members = lambda text: b"".join(gzip.compress(text.encode()[i : i + 50]) for i in range(0, len(text.encode()), 50))
    for name, text in texts.items():
        for folder, content in (("plain", text.encode()), ("whole", members(text))):
            (tmp_path / folder).mkdir(exist_ok=True)
            (tmp_path / folder / (f"{name}.log" + ".gz" * (folder == "whole"))).write_bytes(content)
    rows = lambda folder: sorted(
        (r.path.split("/")[-1].removesuffix(".gz"), r.start, r.seq, r.text) for r in logs.read_log_sections(spark, str(tmp_path / folder)).collect()
    )
    want = rows("plain")
    assert {r[0] for r in want} == {"two.log", "inner.log", "open.log", "orphan.log"} and len(want) == 7
    assert rows("whole") == want
    # larger ones come line by line
    monkeypatch.setattr(logs, "WHOLE_BYTES", 300)
    assert rows("whole") == want


def test_sections_over_splits_are_read_once(spark, tmp_path):
    long = "\n".join(f"k{i}=v{i}" for i in range(2000))
    (tmp_path / "a.log").write_text(f"{block(long)}\n")
    with workdir.session_conf(spark, {"spark.sql.files.maxPartitionBytes": "5000", "spark.sql.files.openCostInBytes": "0"}):
        sections = logs.read_log_sections(spark, str(tmp_path))
        # what comes back reads stored pieces; steps that read the logs would each read them again
        plan = sections._jdf.queryExecution().executedPlan().toString()
        assert "Format: Text" not in plan and "FileScan text" not in plan and "FileScan parquet" in plan
        assert len(runlog.parse_blocks(sections, keep=[]).first().kv) == 2005
