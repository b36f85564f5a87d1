"""Predicted beside measured, node-count comparison, cost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.sources.workdir import broadcast_if_small

PREDICTION_KEYS = ["stage", "phase", "nodes"]

# Rows of a full ledger, one scan and two phases at each of two cluster sizes.
LEDGER_ROWS = 5


def with_predictions(ledger: DataFrame, predictions: DataFrame, keys: Sequence[str] = PREDICTION_KEYS) -> DataFrame:
    """All measured rows, with their prediction in ``predicted_s``; null where there is none."""
    measured = ledger.drop("predicted_s")
    return measured.join(predictions.select(*keys, "predicted_s"), list(keys), "left")


def ledger_complete(ledger: DataFrame, by: Sequence[str] = ("resource_id",), rows: int = LEDGER_ROWS) -> DataFrame:
    """Per ledger: number of rows and whether each (stage, nodes, phase) occurs once."""
    cells = ledger.groupBy(*by, *PREDICTION_KEYS).agg(F.count(F.lit(1)).alias("n"))
    return cells.groupBy(*by).agg(
        F.sum("n").alias("n_rows"),
        (F.max("n") == 1).alias("is_unique"),
        ((F.sum("n") == rows) & (F.max("n") == 1)).alias("complete"),
    )


def compare_nodes(
    ledger: DataFrame, by: Sequence[str] = ("resource_id", "phase"), small: int = 2, large: int = 4
) -> DataFrame:
    """Predicted and measured time at two node counts, and the measured ratio between them.

    ``n_small`` and ``n_large`` count the rows behind each side; above one the largest value is shown.
    """

    def at(value: str, nodes: int) -> Column:
        return F.max(F.when(F.col("nodes") == nodes, F.col(value).cast("double")))

    return ledger.groupBy(*by).agg(
        at("predicted_s", small).alias("predicted_small_s"),
        at("predicted_s", large).alias("predicted_large_s"),
        at("wall_s", small).alias("wall_small_s"),
        at("wall_s", large).alias("wall_large_s"),
        F.try_divide(at("wall_s", small), at("wall_s", large)).alias("speedup"),
        F.count_if(F.col("nodes") == small).alias("n_small"),
        F.count_if(F.col("nodes") == large).alias("n_large"),
    )


def seconds_per_fit(blocks: DataFrame, keep: Sequence[str] = ("path",)) -> DataFrame:
    """Core-seconds per fit of every block that reports fits."""
    num = lambda k: F.col("kv")[k].try_cast("double")
    fits = blocks.filter(num("fits_done") > 0)
    return fits.select(*keep, (num("wall_s") * num("effective_parallelism") / num("fits_done")).alias("seconds_per_fit"))


def with_cost(ledger: DataFrame, prices: DataFrame, on: str = "instance_type") -> DataFrame:
    """Cost of a row: its seconds (wait and work) times hourly rate times billed nodes.

    ``prices`` has one row per instance type with the hourly ``rate_usd``. A cluster row
    (``nodes`` > 1) also pays for the primary node. A row whose type has no price keeps a null cost.
    """
    num = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    billed = F.col("nodes") + F.when(F.col("nodes") > 1, 1).otherwise(0)
    cost = (num("startup_s") + num("wall_s")) / 3600 * F.col("rate_usd") * billed
    return ledger.drop("cost_usd").join(broadcast_if_small(prices.select(on, "rate_usd")), on, "left").withColumn("cost_usd", cost)
