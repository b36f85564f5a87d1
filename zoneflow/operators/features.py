"""Zone lookup join, per-zone features, key checks."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.exprs import at_least, avg_if_complete, nan_to_null
from zoneflow.operators.matrix import TAXI, TripColumns
from zoneflow.operators.heavy import heavy_keys
from zoneflow.operators.quantiles import Quantile, summarise
from zoneflow.sources.workdir import MAX_BROADCAST_BYTES, broadcast_if_small, materialise

MIN_FARE = 0.01
MIN_DISTANCE = 0.1

# Rows of one zone that a pandas function may receive as one frame.
MAX_FRAME_ROWS = 1_000_000


def lookup_join(
    trips: DataFrame, lookup: DataFrame, trip_key: str, lookup_key: str, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Left join that keeps unmatched trips; the lookup is broadcast when its measured size allows."""
    small = broadcast_if_small(lookup, max_bytes)
    return trips.join(small, trips[trip_key] == lookup[lookup_key], "left")


def duplicate_keys(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, which would multiply trips in the join."""
    return lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def key_uniqueness(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: distinct keys, duplicated keys, and whether the key is unique."""
    sizes = lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("n_duplicated"),
        (F.count_if(F.col("n") > 1) == 0).alias("is_unique"),
    )


def key_skew(df: DataFrame, key: str) -> DataFrame:
    """Rows, keys, and the share of the hottest key."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.max("n").alias("max_rows"),
        (F.max("n") / F.sum("n")).alias("max_share"),
    )


def repartition_by_key(df: DataFrame, key: str, n: int) -> DataFrame:
    """Every row of a key in one of ``n`` chunks. A hot key makes a hot chunk: see ``key_skew``."""
    return df.repartition(n, key)


def _measures(df: DataFrame, cols: TripColumns) -> DataFrame:
    """Key and the four measures; nothing else of the joined row goes on."""
    fare, tip, dist = (nan_to_null(F.col(c).cast("double")) for c in (cols.fare, cols.tip, cols.distance))
    return df.select(
        F.col(cols.zone).cast("int").alias(cols.zone),
        fare.alias("fare"),
        (tip / at_least(fare, MIN_FARE)).alias("tip_ratio"),
        dist.alias("distance"),
        (fare / at_least(dist, MIN_DISTANCE)).alias("fare_rate"),
    )


# What a zone's features are, once for every surface: means of a measure (strict: null when a value is
# missing) and quantiles.
MEANS = {"mean_fare": ("fare", False), "mean_tip_ratio": ("tip_ratio", True)}
QUANTILES = [Quantile("p90_distance", "distance", 0.9, strict=True), Quantile("fare_per_km", "fare_rate", 0.5)]


def _mean(measure: str, strict: bool) -> Column:
    return avg_if_complete(F.col(measure)) if strict else F.avg(measure)


def zone_features(trips: DataFrame, cols: TripColumns = TAXI, approximate: bool = False, tasks: int | None = None) -> DataFrame:
    """Trips, mean fare, mean tip ratio, 90th percentile distance and median fare rate per zone.

    A mean tip ratio or distance percentile is null when the zone misses any of its values; the
    mean fare and the median skip missing ones. ``approximate`` trades exact percentiles for one
    sketch pass. ``tasks``: ranges of (zone, value) that the exact ones are dealt to.
    """
    aggs = [F.count(F.lit(1)).alias("n_trips"), *(_mean(*m).alias(name) for name, m in MEANS.items())]
    measures = _measures(trips, cols)
    if approximate:
        rows = measures.na.drop(subset=[cols.zone])
        return rows.groupBy(cols.zone).agg(*aggs, *(q.approximate() for q in QUANTILES))
    return summarise(measures, [cols.zone], aggs, QUANTILES, tasks)


def percentile_ranks(trips: DataFrame, features: DataFrame, cols: TripColumns = TAXI) -> DataFrame:
    """How far ``p90_distance`` and ``fare_per_km`` of given features are off, per zone, in shares of the zone's rows.

    The rank error is the distance of the wanted fraction from the range of shares that the value covers
    (rows below it to rows not above it); an exact element has none.
    """
    values = features.select(cols.zone, *(F.col(q.name).alias(f"__{q.name}") for q in QUANTILES))
    rows = _measures(trips, cols).join(values, cols.zone)

    def error(q: Quantile) -> Column:
        v, at = F.col(q.column), F.col(f"__{q.name}")
        below, upto = F.count_if(v < at) / F.count(v), F.count_if(v <= at) / F.count(v)
        return F.greatest(F.lit(0.0), below - q.fraction, q.fraction - upto)

    return rows.groupBy(cols.zone).agg(F.count(F.lit(1)).alias("n_trips"), *(error(q).alias(f"{q.name}_off") for q in QUANTILES))


def zone_features_grouped(trips: DataFrame, cols: TripColumns = TAXI, max_frame: int = MAX_FRAME_ROWS) -> DataFrame:
    """The same features from a pandas function that sees a whole zone as one frame.

    Only zones of at most ``max_frame`` rows are handed over; larger ones take the built-in path,
    which never holds a zone in one place.
    """
    key = cols.zone
    measures = _measures(trips, cols).na.drop(subset=[key])

    def of_zone(zone: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        whole = frame.notna().all()
        means = {n: frame[m].mean() if whole[m] or not strict else None for n, (m, strict) in MEANS.items()}
        cuts = {q.name: frame[q.column].quantile(q.fraction) if whole[q.column] or not q.strict else None for q in QUANTILES}
        return pd.DataFrame([{key: zone[0], "n_trips": len(frame), **means, **cuts}])

    schema = ", ".join([f"`{key}` int", "n_trips long", *(f"{n} double" for n in [*MEANS, *(q.name for q in QUANTILES)])])
    by_frame = lambda d: d.groupBy(key).applyInPandas(of_zone, schema)
    hot = materialise(heavy_keys(measures, [key], min_rows=max_frame + 1).select(key))
    if not hot.take(1):
        return by_frame(measures)
    large = trips.join(hot, trips[key].cast("int") == hot[key], "left_semi")
    rest = zone_features(large, cols)
    return by_frame(measures.join(hot, [key], "left_anti")).unionByName(rest)
