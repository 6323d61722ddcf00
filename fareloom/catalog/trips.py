"""Staging, facts, marts and checks on the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import quality
from ..plans import marts
from ..plans import trips as models
from ..schemas import MONEY_COLUMNS
from ..session import fresh_dir, fresh_name
from ..sinks.tables import Layers
from .mapping import (FACT_SQL, FHV_SQL, MONEY_AS_DOUBLE, STAGED_SQL, ZONES_SQL, raw_fhv, raw_zones,
                      table, trips)
from .registry import query


def staged(spark, sf_dir):
    return models.stage_trips(trips(spark, sf_dir))


def fact(spark, sf_dir):
    return models.fact_trips(staged(spark, sf_dir), models.dim_zones(raw_zones(spark, sf_dir)))


def fhv(spark, sf_dir):
    return models.dim_fhv_trips(models.stage_fhv(raw_fhv(spark, sf_dir)),
                                models.dim_zones(raw_zones(spark, sf_dir)))


@query("stage_trips", f"""
WITH {STAGED_SQL}
SELECT * REPLACE (CAST(trip_distance AS DOUBLE) AS trip_distance,
                  {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MONEY_COLUMNS)})
FROM staged""")
def stage_trips(spark, sf_dir):
    return staged(spark, sf_dir)


@query("fact_trips", f"""
WITH {FACT_SQL}
SELECT tripid, vendorid, service_type, ratecodeid, pickup_locationid, pickup_borough, pickup_zone,
       dropoff_locationid, dropoff_borough, dropoff_zone, pickup_datetime, dropoff_datetime,
       store_and_fwd_flag, passenger_count, CAST(trip_distance AS DOUBLE) AS trip_distance,
       trip_type, {MONEY_AS_DOUBLE}, payment_type, payment_type_description
FROM fact""")
def fact_trips(spark, sf_dir):
    return fact(spark, sf_dir)


@query("stage_fhv", f"WITH {FHV_SQL} SELECT * FROM fhv")
def stage_fhv(spark, sf_dir):
    return models.stage_fhv(raw_fhv(spark, sf_dir))


@query("dim_fhv_trips", f"""
WITH {FHV_SQL} SELECT * FROM dim_fhv""")
def dim_fhv_trips(spark, sf_dir):
    return fhv(spark, sf_dir)


_SUMS = ", ".join(
    f"CAST(SUM({c}) AS DOUBLE) AS revenue_monthly_{'fare' if c == 'fare_amount' else c}"
    for c in MONEY_COLUMNS)


@query("monthly_zone_revenue", f"""
WITH {FACT_SQL}
SELECT pickup_zone AS revenue_zone,
       CAST(date_trunc('month', pickup_datetime) AS TIMESTAMP) AS revenue_month, service_type,
       {_SUMS}, COUNT(tripid) AS total_monthly_trips,
       ROUND(AVG(passenger_count), 6) AS avg_monthly_passenger_count,
       ROUND(AVG(CAST(trip_distance AS DOUBLE)), 6) AS avg_monthly_trip_distance
FROM fact GROUP BY 1, 2, 3""")
def monthly_zone_revenue(spark, sf_dir):
    mart = marts.monthly_zone_revenue(fact(spark, sf_dir))
    return mart.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in
                             ["avg_monthly_passenger_count", "avg_monthly_trip_distance"]})


_QUARTERLY = f"""
WITH {FACT_SQL},
grouped AS (
  SELECT service_type, CAST(year(pickup_datetime) AS INTEGER) AS year,
         CAST(quarter(pickup_datetime) AS INTEGER) AS quarter, SUM(total_amount) AS total_amount
  FROM fact GROUP BY 1, 2, 3),
lagged AS (
  SELECT *, LAG(total_amount) OVER (PARTITION BY service_type, quarter ORDER BY year) AS prev
  FROM grouped),
revenue AS (
  SELECT service_type, year, quarter, CAST(total_amount AS DOUBLE) AS total_amount,
         CAST(prev AS DOUBLE) AS prev_year_total_amount,
         ROUND((CAST(total_amount AS DOUBLE) - CAST(prev AS DOUBLE))
               / NULLIF(CAST(prev AS DOUBLE), 0) * 100, 2) AS yoy_percentage_change
  FROM lagged)"""


@query("quarterly_revenue_yoy", f"{_QUARTERLY} SELECT * FROM revenue ORDER BY 1, 2, 3")
def quarterly_revenue_yoy(spark, sf_dir):
    return marts.quarterly_revenue(fact(spark, sf_dir)).orderBy("service_type", "year", "quarter")


@query("best_worst_quarter", f"""{_QUARTERLY},
labelled AS (
  SELECT *, CAST(year AS VARCHAR) || '/Q' || CAST(quarter AS VARCHAR) AS yq FROM revenue
  WHERE year = 2000 AND yoy_percentage_change IS NOT NULL),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY service_type ORDER BY yoy_percentage_change DESC, yq) AS b,
         ROW_NUMBER() OVER (PARTITION BY service_type ORDER BY yoy_percentage_change, yq) AS w
  FROM labelled)
SELECT b.service_type, b.yq AS best_year_quarter,
       b.yoy_percentage_change AS best_yoy_percentage_change, w.yq AS worst_year_quarter,
       w.yoy_percentage_change AS worst_yoy_percentage_change
FROM ranked b JOIN ranked w ON b.service_type = w.service_type AND b.b = 1 AND w.w = 1""")
def best_worst_quarter(spark, sf_dir):
    return marts.best_worst_quarter(marts.quarterly_revenue(fact(spark, sf_dir)), 2000)


_PAID = f"""
WITH {FACT_SQL},
paid AS (
  SELECT service_type, CAST(year(pickup_datetime) AS INTEGER) AS year,
         CAST(month(pickup_datetime) AS INTEGER) AS month, CAST(fare_amount AS DOUBLE) AS fare_amount,
         CAST(trip_distance AS DOUBLE) AS trip_distance, payment_type_description
  FROM fact WHERE fare_amount > 0 AND trip_distance > 0
    AND lower(payment_type_description) IN ('cash', 'credit card'))"""
_FARES = ", ".join(f"ROUND(quantile_cont(fare_amount, {p}), 4) AS {n}"
                   for n, p in marts.FARE_PROBS.items())


@query("monthly_fare_percentiles", f"{_PAID} SELECT service_type, year, month, {_FARES} FROM paid "
       "GROUP BY 1, 2, 3")
def monthly_fare_percentiles(spark, sf_dir):
    mart = marts.monthly_fare_percentiles(fact(spark, sf_dir))
    return mart.withColumns({n: F.round(n, 4) for n in marts.FARE_PROBS})


@query("fare_percentile_window", f"""{_PAID},
grouped AS (SELECT service_type, year, month, {_FARES} FROM paid GROUP BY 1, 2, 3)
SELECT * FROM paid JOIN grouped USING (service_type, year, month)""")
def fare_percentile_window(spark, sf_dir):
    stored = Layers(spark, fresh_name("fares") + "_", fresh_dir(spark, "fares")).store("fact", fact(spark, sf_dir), "table")
    rows = marts.fare_percentile_window(stored)
    return rows.withColumns({n: F.round(n, 4) for n in marts.FARE_PROBS})


_ROUTES = f"""
WITH {FHV_SQL},
routes AS (
  SELECT year, month, pickup_locationid, dropoff_locationid, pickup_zone, dropoff_zone,
         ROUND(quantile_cont(date_diff('second', pickup_datetime, dropoff_datetime), 0.9), 4) AS p90
  FROM dim_fhv GROUP BY ALL)"""


@query("route_duration_p90", f"{_ROUTES} SELECT * FROM routes")
def route_duration_p90(spark, sf_dir):
    return marts.route_duration_p90(fhv(spark, sf_dir)).withColumn("p90", F.round("p90", 4))


@query("nth_longest_route", f"""{_ROUTES}
SELECT * EXCLUDE (place) FROM (
  SELECT *, DENSE_RANK() OVER (PARTITION BY year, month, pickup_zone ORDER BY p90 DESC) AS place
  FROM routes)
WHERE place = 2""")
def nth_longest_route(spark, sf_dir):
    routes = marts.route_duration_p90(fhv(spark, sf_dir)).withColumn("p90", F.round("p90", 4))
    return marts.nth_longest_route(routes, 2)


@query("model_layers", f"""
WITH {FACT_SQL}
SELECT service_type, COUNT(*) AS trips, CAST(SUM(total_amount) AS DOUBLE) AS total_amount
FROM fact GROUP BY 1""")
def model_layers(spark, sf_dir):
    layers = Layers(spark, fresh_name("model") + "_", fresh_dir(spark, "model"))
    zones = models.dim_zones(raw_zones(spark, sf_dir), layers=layers)
    stage = models.stage_trips(trips(spark, sf_dir), layers=layers)
    stored = models.fact_trips(stage, zones, layers=layers)
    return stored.groupBy("service_type").agg(F.count("*").alias("trips"),
                                              F.sum("total_amount").alias("total_amount"))


_CHECK = "'{0}' AS \"check\", '{1}' AS \"column\", '{2}' AS severity"


def _check_sql(check, column, severity, failures):
    return f"SELECT {_CHECK.format(check, column, severity)}, {failures} AS failures"


_UNIQUE_SQL = _check_sql(
    "unique", "l_orderkey", "warn",
    "(SELECT COUNT(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1))")


@query("check_unique", _UNIQUE_SQL)
def check_unique(spark, sf_dir):
    return quality.check_unique(table(spark, sf_dir, "lineitem"), "l_orderkey", quality.WARN)


@query("check_not_null", " UNION ALL ".join(
    _check_sql("not_null", c, "error", f"(SELECT COUNT(*) FROM orders WHERE {c} IS NULL)")
    for c in ("o_orderkey", "o_custkey", "o_orderdate")))
def check_not_null(spark, sf_dir):
    return quality.check_not_null(table(spark, sf_dir, "orders"),
                                  ["o_orderkey", "o_custkey", "o_orderdate"])


@query("check_accepted_values", _check_sql(
    "accepted_values", "l_returnflag", "warn",
    "(SELECT COUNT(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N'))"))
def check_accepted_values(spark, sf_dir):
    return quality.check_accepted(table(spark, sf_dir, "lineitem"), "l_returnflag", ["A", "N"],
                                  quality.WARN)


@query("check_relationships", _check_sql(
    "relationships", "l_orderkey", "error",
    "(SELECT COUNT(*) FROM lineitem WHERE l_orderkey NOT IN "
    "(SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'))"))
def check_relationships(spark, sf_dir):
    # Pending orders are left out of the parent, so that there is something to find.
    orders = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    return quality.check_relationships(table(spark, sf_dir, "lineitem"), "l_orderkey", orders,
                                       "o_orderkey")


@query("check_row_total", _check_sql(
    "row_total", "*", "error",
    "(SELECT abs((SELECT COUNT(*) FROM orders) - (SELECT COUNT(*) FROM lineitem)))"))
def check_row_total(spark, sf_dir):
    expected = table(spark, sf_dir, "lineitem").count()
    return quality.check_row_total(table(spark, sf_dir, "orders"), expected)


@query("check_freshness", _check_sql(
    "freshness", "ts", "error",
    "(SELECT CAST(MAX(ts) < TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 6 HOUR AS BIGINT) FROM events)"))
def check_freshness(spark, sf_dir):
    return quality.check_freshness(table(spark, sf_dir, "events"), "ts", 6,
                                   dt.datetime(2024, 2, 1))


_STATUS = ("SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM (")


@query("quality_report", f"WITH {STAGED_SQL}, {ZONES_SQL} {_STATUS}" + " UNION ALL ".join([
    _check_sql("unique", "tripid", "warn",
               "(SELECT COUNT(*) FROM (SELECT tripid FROM staged GROUP BY 1 HAVING COUNT(*) > 1))"),
    _check_sql("not_null", "tripid", "warn", "(SELECT COUNT(*) FROM staged WHERE tripid IS NULL)"),
    _check_sql("accepted_values", "payment_type", "warn",
               "(SELECT COUNT(*) FROM staged WHERE payment_type NOT IN (1, 2, 3, 4, 5, 6))"),
    *[_check_sql("relationships", c, "warn",
                 f"(SELECT COUNT(*) FROM staged WHERE {c} NOT IN (SELECT locationid FROM zones "
                 "WHERE borough <> 'Unknown'))")
      for c in ("pickup_locationid", "dropoff_locationid")],
    _check_sql("not_null", "locationid", "error",
               "(SELECT COUNT(*) FROM zones WHERE locationid IS NULL)"),
]) + ")")
def quality_report(spark, sf_dir):
    """The checked columns of all staged trips are stored once; every check then reads its own."""
    layers = Layers(spark, fresh_name("checked") + "_", fresh_dir(spark, "checked"))
    zones = models.dim_zones(raw_zones(spark, sf_dir), layers=layers)
    checked = ["tripid", "payment_type", "pickup_locationid", "dropoff_locationid"]
    stage = layers.store("trips", staged(spark, sf_dir).select(*checked), "table")
    known = models.known_zones(zones)
    warn = quality.WARN
    return quality.enforce(quality.quality_report([
        quality.check_unique(stage, "tripid", warn),
        quality.check_columns(stage, ["tripid"], {"payment_type": models.ACCEPTED_PAYMENTS}, warn),
        quality.check_relationships(stage, "pickup_locationid", known, "locationid", warn),
        quality.check_relationships(stage, "dropoff_locationid", known, "locationid", warn),
        quality.check_not_null(zones, ["locationid"]),
    ]))
