"""Runs that time themselves and report as metrics blocks, so that checks and ledgers take our own runs as well."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.exprs import megabytes_per_second
from zoneflow.operators import cv, matrix
from zoneflow.operators.matrix import TAXI, TripColumns
from zoneflow.operators.runlog import block_text
from zoneflow.sources.files import byte_totals
from zoneflow.sources.workdir import materialise

# The headers by which run checks know the two kinds of runs.
SCAN_HEADER = {"mode": "duckdb", "platform": "spark", "stage": "1_scan", "phase": "scan"}
GRID_HEADER = {"mode": "rest", "platform": "spark", "stage": "2_grid", "phase": "B_fit"}


def _block(one_row: DataFrame, header: Mapping[str, str], body: Mapping[str, object]) -> DataFrame:
    text = block_text({k: F.lit(v) for k, v in header.items()}, {k: F.lit(v) for k, v in body.items()})
    return one_row.select(text.alias("text"))


def timed_scan(
    trips: DataFrame, footer_rows: DataFrame, start: str, end: str, needed: Sequence[str] | None = None, path: str | None = None,
    cols: TripColumns = TAXI, header: Mapping[str, str] = SCAN_HEADER,
) -> tuple[DataFrame, DataFrame]:
    """The stored model matrix, and ``text``: the block of the run that made it.

    A first pass reads every projected column and writes nothing (``t_read_s``); a second reads, filters and writes
    (``wall_s``). Their difference, not below zero, is ``t_write_s``. ``footer_rows`` of the trips' files give the bytes
    on disk and those the projection needs; with the read time and the cores they give the rate.
    """
    spark = trips.sparkSession
    sizes = byte_totals(footer_rows, list(needed or cols.projected)).first()
    begun = time.monotonic()
    counts = matrix.matrix_profile(trips, start, end, cols).first()
    read = time.monotonic() - begun
    begun = time.monotonic()
    stored = materialise(matrix.model_matrix(trips, start, end, cols), path)
    wall = time.monotonic() - begun
    cores = spark.sparkContext.defaultParallelism
    body = {
        "wall_s": round(wall, 1), "t_total_s": round(wall, 2), "bytes_on_disk": sizes["bytes_on_disk"], "bytes_needed": sizes["bytes_needed"],
        "rows_in": counts["rows_in"], "rows_out": counts["rows_out"], "t_read_s": round(read, 2), "t_write_s": round(max(0.0, wall - read), 2),
        "mb_per_s_per_core": megabytes_per_second(F.lit(sizes["bytes_needed"]), F.lit(read), cores), "cores": cores, "ended_at_epoch_s": round(time.time(), 1),
    }
    text = block_text({k: F.lit(v) for k, v in header.items()}, {k: v if k == "mb_per_s_per_core" else F.lit(v) for k, v in body.items()})
    return stored, spark.range(1).select(text.alias("text"))


def timed_grid(
    design: DataFrame, features: Sequence[str] = cv.FEATURES, target: str = cv.TARGET, combos: int = cv.COMBOS, folds: int = cv.FOLDS,
    rounds: int = cv.FIT_ROUNDS, header: Mapping[str, str] = GRID_HEADER,
) -> tuple[DataFrame, DataFrame]:
    """The stored scores of the grid, and ``text``: the block of the run with its wall time, fits and parallelism."""
    spark = design.sparkSession
    begun = time.monotonic()
    scores = materialise(cv.grid_scores(design, features, target, combos, folds, rounds))
    wall, fits = time.monotonic() - begun, scores.filter("score IS NOT NULL").count()
    body = {
        "wall_s": round(wall, 3), "fits_done": fits, "effective_parallelism": cv.effective_parallelism(spark, combos * folds),
        "retried": 0, "rest_target": "self", "ended_at_epoch_s": round(time.time(), 1),
    }
    return scores, _block(spark.range(1), header, body)
