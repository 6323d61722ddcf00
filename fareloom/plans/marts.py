"""Marts over the trip fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_parts, month_start, seconds_between
from ..operators.aggregates import sum_by
from ..operators.filters import where_in, where_positive
from ..operators.percentiles import percentiles_by, percentiles_over
from ..operators.windows import best_worst, nth_by, yoy
from ..schemas import MONEY_COLUMNS
from ..sinks.tables import model

FARE_KEYS = ["service_type", "year", "month"]
FARE_PROBS = {"p97": 0.97, "p95": 0.95, "p90": 0.90}
ROUTE_KEYS = ["year", "month", "pickup_locationid", "dropoff_locationid"]


@model("table")
def monthly_zone_revenue(fact: DataFrame) -> DataFrame:
    """Sums, trips and averages by pickup zone, month and service, in one aggregation."""
    return fact.groupBy(
        F.col("pickup_zone").alias("revenue_zone"),
        month_start("pickup_datetime").alias("revenue_month"), "service_type",
    ).agg(
        *[F.sum(c).alias("revenue_monthly_" + c.removesuffix("_amount") if c == "fare_amount"
                         else f"revenue_monthly_{c}") for c in MONEY_COLUMNS],
        F.count("tripid").alias("total_monthly_trips"),
        F.avg("passenger_count").alias("avg_monthly_passenger_count"),
        F.avg("trip_distance").alias("avg_monthly_trip_distance"),
    )


def quarterly_totals(fact: DataFrame) -> DataFrame:
    year, _, quarter = date_parts("pickup_datetime")
    return sum_by(fact.select("service_type", year, quarter, "total_amount"),
                  ["service_type", "year", "quarter"], "total_amount")


@model("table")
def quarterly_revenue(fact: DataFrame, strict_year: bool = False) -> DataFrame:
    """Revenue by service and quarter with the growth against the year before.

    A table has no order: sort by service, year and quarter on reading.
    """
    return yoy(quarterly_totals(fact), ["service_type", "quarter"], "year", "total_amount",
               strict_year)


def best_worst_quarter(revenue: DataFrame, year: int) -> DataFrame:
    """Per service, the quarter of ``year`` with the best and with the worst growth."""
    labelled = revenue.where(F.col("year") == year).withColumn(
        "year_quarter", F.concat(F.col("year").cast("string"), F.lit("/Q"),
                                 F.col("quarter").cast("string")))
    return best_worst(labelled, ["service_type"], "year_quarter", "yoy_percentage_change")


def paid_fares(fact: DataFrame) -> DataFrame:
    """Trips with a fare and a distance, paid in cash or by card."""
    paid = where_in(where_positive(fact, ["fare_amount", "trip_distance"]),
                    "payment_type_description", ["cash", "credit card"], lower=True)
    year, month, _ = date_parts("pickup_datetime")
    return paid.select("service_type", year, month, "fare_amount", "trip_distance",
                       "payment_type_description")


@model("table")
def monthly_fare_percentiles(fact: DataFrame, approx: bool = False) -> DataFrame:
    return percentiles_by(paid_fares(fact), FARE_KEYS, "fare_amount",
                          list(FARE_PROBS.values()), list(FARE_PROBS), approx)


def fare_percentile_window(fact: DataFrame) -> DataFrame:
    """One row per paid trip with the percentiles of its month. The stored fact is read twice."""
    return percentiles_over(paid_fares(fact), FARE_KEYS, "fare_amount",
                            list(FARE_PROBS.values()), list(FARE_PROBS))


@model("table")
def route_duration_p90(fhv: DataFrame, approx: bool = False) -> DataFrame:
    """90th percentile of the trip seconds per month and route; routes are pairs of zone ids."""
    timed = fhv.select(
        *ROUTE_KEYS, "pickup_zone", "dropoff_zone",
        seconds_between("pickup_datetime", "dropoff_datetime").alias("trip_seconds"))
    # An id has one zone name, so the names may be part of the key.
    return percentiles_by(timed, [*ROUTE_KEYS, "pickup_zone", "dropoff_zone"], "trip_seconds",
                          [0.90], ["p90"], approx)


def nth_longest_route(routes: DataFrame, n: int, pickup_zones: list[str] | None = None,
                      year: int | None = None, month: int | None = None) -> DataFrame:
    """The route with the n-th longest p90 from each pickup zone and month."""
    if pickup_zones is not None:
        routes = where_in(routes, "pickup_zone", pickup_zones)
    if year is not None:
        routes = routes.where(F.col("year") == year)
    if month is not None:
        routes = routes.where(F.col("month") == month)
    return nth_by(routes, ["year", "month", "pickup_zone"], "p90", n)
