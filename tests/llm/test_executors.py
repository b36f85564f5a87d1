"""Queries in a process whose workers cannot import the package."""

import subprocess
import sys

from conftest import ROOT, SF_SMALL

JOB = """
import os, sys, tempfile
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from zoneflow.llm.queries import QUERIES
import corpus_pipeline

spark = (
    SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", tempfile.mkdtemp(dir=os.getcwd())).getOrCreate()
)

def absent(batches):
    import importlib.util
    for b in batches:
        assert importlib.util.find_spec("zoneflow") is None
        yield b

assert spark.range(4).mapInArrow(absent, "id long").count() == 4
for name, query in {**QUERIES, "pipeline": corpus_pipeline.run}.items():
    print(name, query(spark, sys.argv[2]).count(), flush=True)
"""


def test_all_queries_run_where_workers_have_no_package(tmp_path):
    done = subprocess.run([sys.executable, "-c", JOB, str(ROOT), SF_SMALL], cwd=tmp_path, capture_output=True, text=True, timeout=1500)
    assert done.returncode == 0, done.stderr[-3000:]
    names = [line.split()[0] for line in done.stdout.splitlines() if line.strip()]
    assert [n.split("_")[0] for n in names] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
