"""Model matrix: window, validity predicates, projection, and the profile of the read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TripColumns:
    """Names of the six columns the model reads; the defaults are the taxi files' names."""

    ts: str = "tpep_pickup_datetime"
    zone: str = "PULocationID"
    distance: str = "trip_distance"
    passengers: str = "passenger_count"
    fare: str = "fare_amount"
    tip: str = "tip_amount"

    @property
    def projected(self) -> list[str]:
        return [self.ts, self.zone, self.distance, self.passengers, self.fare, self.tip]


TAXI = TripColumns()


def in_window(ts: str, start: str, end: str) -> Column:
    """Half-open window on a timestamp without zone; the bounds push down to the scan."""
    bound = lambda s: F.lit(s).cast("timestamp_ntz")
    return (F.col(ts) >= bound(start)) & (F.col(ts) < bound(end))


def valid_trip(cols: TripColumns = TAXI) -> Column:
    return (
        (F.col(cols.fare) > 0)
        & (F.col(cols.distance) > 0)
        & F.col(cols.zone).isNotNull()
        & F.col(cols.passengers).isNotNull()
    )


def model_matrix(trips: DataFrame, start: str, end: str, cols: TripColumns = TAXI) -> DataFrame:
    """Valid trips of the study window, six columns."""
    return trips.filter(in_window(cols.ts, start, end) & valid_trip(cols)).select(*cols.projected)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of missing values (null or NaN) per column, all columns in one pass."""

    def missing(c: str) -> Column:
        null = F.col(c).isNull()
        return null | F.isnan(c) if df.schema[c].dataType.typeName() in ("float", "double") else null

    return df.agg(*(F.count_if(missing(c)).alias(f"nulls_{c}") for c in columns))


def matrix_profile(trips: DataFrame, start: str, end: str, cols: TripColumns = TAXI) -> DataFrame:
    """Rows before and after the filter, and aggregates that touch every projected column.

    Two scans on purpose: the unfiltered count needs no column at all, and the second one
    keeps its predicates in the scan, where they skip row groups.
    """
    before = trips.agg(F.count(F.lit(1)).alias("rows_in"))
    after = model_matrix(trips, start, end, cols).agg(
        F.count(F.lit(1)).alias("rows_out"),
        F.sum(cols.passengers).alias("sum_passengers"),
        F.sum(cols.tip).alias("sum_tip"),
        F.sum(cols.fare).alias("sum_fare"),
        F.sum(cols.distance).alias("sum_distance"),
        F.max(cols.ts).alias("max_ts"),
        F.max(cols.zone).alias("max_zone"),
        F.count_if(F.col(cols.tip).isNull()).alias("nulls_tip"),
        F.count_if(F.col(cols.passengers).isNull()).alias("nulls_passengers"),
    )
    both = before.unionByName(after, allowMissingColumns=True)
    return both.agg(*(F.max(c).alias(c) for c in both.columns))


def drop_incomplete(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows that miss (null or NaN) any of the named columns."""
    return df.na.drop(subset=list(subset))
