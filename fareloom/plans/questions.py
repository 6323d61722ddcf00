"""Single questions asked of trip tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bucket, day, hours_between, thousands
from ..operators.aggregates import (bottom_k, count_by, count_distinct, distinct, max_by_key, max_of,
                                    row_count, sum_by, sum_having, top_by_max, top_k)
from ..operators.filters import Day, between_days, between_half_open, between_literal, on_day
from ..operators.joins import join_dim

# The distance segments of the report.
SEGMENT_EDGES = [1, 3, 7, 10]
SEGMENT_LABELS = ["Up to 1 mile", "1~3 miles", "3~7 miles", "7~10 miles", "10+ miles"]


def segment_counts(trips: DataFrame, pickup: str, dropoff: str, low: Day, high: Day,
                   edges: Sequence[float] = tuple(SEGMENT_EDGES),
                   labels: Sequence[str] = tuple(SEGMENT_LABELS),
                   null_label: str | None = None) -> DataFrame:
    """Trips by distance segment that started and ended in ``[low, high)``."""
    inside = between_half_open(trips, [pickup, dropoff], low, high)
    counts = count_by(inside, {"segment": bucket("trip_distance", edges, labels, null_label)},
                      name="num_trips")
    return counts.withColumn("num_trips_text", thousands("num_trips"))


def longest_trip_day(trips: DataFrame, pickup: str) -> DataFrame:
    return top_by_max(trips, {"pickup_date": day(pickup)}, "trip_distance", "max_trip_distance")


def top_pickup_zones(trips: DataFrame, zones: DataFrame, pickup: str, date: Day, floor, k: int = 3
                     ) -> DataFrame:
    """Pickup zones of one day whose revenue passes ``floor``.

    Trips are summed per location before they meet the zones, so the join sees one row per location.
    """
    by_location = sum_by(on_day(trips, pickup, date), ["pulocationid"], "total_amount")
    named = join_dim(by_location, zones, "pulocationid", "locationid", ["zone"])
    sums = sum_having(named.withColumnRenamed("zone", "pickup_zone"), ["pickup_zone"],
                      "total_amount", floor, "total_amount_sum")
    return top_k(sums, "total_amount_sum", k, ["pickup_zone"])


def largest_tip_zone(trips: DataFrame, zones: DataFrame, pickup: str, low: Day, high: Day,
                     zone: str) -> DataFrame:
    """The drop-off zone with the largest tip among trips that started in ``zone``.

    The ids of the zone, a handful, are looked up first: as literals they reach the scan of the trips.
    """
    ids = [r[0] for r in zones.where(F.col("zone") == zone).select("locationid").distinct().collect()]
    inside = between_days(trips.where(F.col("pulocationid").isin(ids)), pickup, low, high)
    by_drop = max_by_key(inside, ["dolocationid"], "tip_amount", "tip")
    named = join_dim(by_drop, zones.withColumnRenamed("zone", "dropoff_zone"), "dolocationid", "locationid",
                     ["dropoff_zone"])
    return top_by_max(named, ["dropoff_zone"], "tip", "largest_tip")


def trips_on_day(trips: DataFrame, pickup: str, date: Day) -> DataFrame:
    return row_count(on_day(trips, pickup, date), "trips")


def longest_trip_hours(trips: DataFrame, pickup: str, dropoff: str) -> DataFrame:
    return max_of(trips, hours_between(pickup, dropoff), "longest_trip_hours")


def pickups_by_zone(trips: DataFrame, zones: DataFrame, how: str = "inner") -> DataFrame:
    """Trips per zone name. ``how="right"`` keeps zones without trips, with a count of 0.

    Locations are counted before the join; zones that share a name are added up after it.
    """
    by_location = count_by(trips, ["pulocationid"], "pulocationid", "n")
    named = join_dim(by_location, zones, "pulocationid", "locationid", ["zone"], how)
    return named.groupBy("zone").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("pickup_count"))


def least_frequent_zone(trips: DataFrame, zones: DataFrame) -> DataFrame:
    return bottom_k(pickups_by_zone(trips, zones), "pickup_count", 1, ["zone"])


def vendors_between(trips: DataFrame, dropoff: str, low: Day, high: Day,
                    part: str | None = None) -> DataFrame:
    return distinct(between_literal(trips, dropoff, low, high, part), ["vendorid"])


def distinct_pickups(trips: DataFrame, approx: bool = False) -> DataFrame:
    return count_distinct(trips, "pulocationid", "pickup_locations", approx)


def zero_fares(trips: DataFrame) -> DataFrame:
    return row_count(trips.where(F.col("fare_amount") == 0), "trips")
