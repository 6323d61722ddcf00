"""Trip questions on the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import (boundary_minutes, concat_blank, date_parts, day, display_ts,
                         first_non_null, floor_second, hours_between, month_start, naive_utc,
                         null_if, numeric, parse_ts, payment_description, replace_text, row_hash,
                         safe_int, seconds_between, surrogate_key, thousands, year_quarter)
from ..operators.aggregates import count_by, row_count, union_tagged
from ..operators.filters import cap, first_rows, last_days, project
from ..operators.windows import dedup_first
from ..plans import questions as q
from ..plans import trips as models
from .mapping import TRIPS_SQL, ZONES_SQL, raw_zones, table, trips
from .registry import query


@query("scan_project", """
SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem""")
def scan_project(spark, sf_dir):
    return project(table(spark, sf_dir, "lineitem"),
                   ["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"])


@query("segment_counts", """
SELECT CASE WHEN l_quantity <= 1 THEN 'Up to 1 mile' WHEN l_quantity <= 3 THEN '1~3 miles'
            WHEN l_quantity <= 7 THEN '3~7 miles' WHEN l_quantity <= 10 THEN '7~10 miles'
            ELSE '10+ miles' END AS segment,
       COUNT(*) AS num_trips, format('{:,}', COUNT(*)) AS num_trips_text
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '2002-01-01'
  AND l_shipdate >= DATE '1995-01-01' AND l_shipdate < DATE '2002-01-01'
GROUP BY 1""")
def segment_counts(spark, sf_dir):
    rows = trips(spark, sf_dir, pickup=False, dropoff=False)
    return q.segment_counts(rows, "pickup_datetime", "dropoff_datetime", "1995-01-01", "2002-01-01")


@query("longest_trip_day", """
SELECT CAST(o_orderdate AS DATE) AS pickup_date, MAX(l_quantity) AS max_trip_distance
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def longest_trip_day(spark, sf_dir):
    return q.longest_trip_day(trips(spark, sf_dir, pickup=False, dropoff=False), "pickup_datetime")


@query("top_pickup_zones", f"""
WITH {TRIPS_SQL}, {ZONES_SQL}
SELECT zone AS pickup_zone, CAST(SUM(total_amount) AS DOUBLE) AS total_amount_sum
FROM trips JOIN zones ON pulocationid = locationid
WHERE CAST(pickup_datetime AS DATE) = DATE '1998-10-03'
GROUP BY 1 HAVING SUM(total_amount) > 13000 ORDER BY SUM(total_amount) DESC, 1 LIMIT 3""")
def top_pickup_zones(spark, sf_dir):
    return q.top_pickup_zones(trips(spark, sf_dir, dropoff=False), raw_zones(spark, sf_dir),
                              "pickup_datetime", "1998-10-03", 13000)


@query("largest_tip_zone", f"""
WITH {TRIPS_SQL}, {ZONES_SQL}
SELECT d.zone AS dropoff_zone, CAST(MAX(tip_amount) AS DOUBLE) AS largest_tip
FROM trips JOIN zones p ON pulocationid = p.locationid JOIN zones d ON dolocationid = d.locationid
WHERE CAST(pickup_datetime AS DATE) BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
  AND p.zone = 'NATION_7'
GROUP BY 1 ORDER BY MAX(tip_amount) DESC, 1 LIMIT 1""")
def largest_tip_zone(spark, sf_dir):
    return q.largest_tip_zone(trips(spark, sf_dir), raw_zones(spark, sf_dir), "pickup_datetime",
                              "1995-01-01", "2001-12-31", "NATION_7")


@query("trips_on_day", """
SELECT COUNT(*) AS trips FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE CAST(o_orderdate AS DATE) = DATE '1998-10-03'""")
def trips_on_day(spark, sf_dir):
    return q.trips_on_day(trips(spark, sf_dir, pickup=False, dropoff=False), "pickup_datetime",
                          "1998-10-03")


@query("trip_hours", """
SELECT MAX(date_diff('second', o_orderdate, l_shipdate) / 3600.0) AS longest_trip_hours
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def trip_hours(spark, sf_dir):
    return q.longest_trip_hours(trips(spark, sf_dir, pickup=False, dropoff=False),
                                "pickup_datetime", "dropoff_datetime")


@query("count_zero_fare", """
SELECT COUNT(*) AS trips FROM lineitem WHERE l_discount = 0""")
def count_zero_fare(spark, sf_dir):
    # No line has a zero price, so the discount stands for the fare.
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_discount", "fare_amount")
    return q.zero_fares(lines)


@query("count_distinct_pickup", """
SELECT COUNT(DISTINCT s_nationkey) AS pickup_locations
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")
def count_distinct_pickup(spark, sf_dir):
    return q.distinct_pickups(trips(spark, sf_dir, start=False, dropoff=False))


_PICKUPS = f"""
WITH {ZONES_SQL}, t AS (SELECT s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT zone, COUNT(s_nationkey) AS pickup_count"""


@query("least_frequent_zone", f"""{_PICKUPS}
FROM t JOIN zones ON s_nationkey = locationid GROUP BY 1 ORDER BY 2, 1 LIMIT 1""")
def least_frequent_zone(spark, sf_dir):
    return q.least_frequent_zone(trips(spark, sf_dir, start=False, dropoff=False),
                                 raw_zones(spark, sf_dir))


@query("zone_activity_left", f"""{_PICKUPS}
FROM zones LEFT JOIN t ON s_nationkey = locationid GROUP BY 1""")
def zone_activity_left(spark, sf_dir):
    return q.pickups_by_zone(trips(spark, sf_dir, start=False, dropoff=False),
                             raw_zones(spark, sf_dir), how="right")


@query("payment_descriptions", """
SELECT TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type,
       CASE TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) WHEN 1 THEN 'Credit card'
            WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown'
            WHEN 6 THEN 'Voided trip' ELSE 'EMPTY' END AS payment_type_description,
       COUNT(*) AS orders
FROM orders GROUP BY 1, 2""")
def payment_descriptions(spark, sf_dir):
    code = F.substring("o_orderpriority", 1, 1)
    return count_by(table(spark, sf_dir, "orders"),
                    {"payment_type": safe_int(code),
                     "payment_type_description": payment_description(code)}, name="orders")


@query("recent_trips", """
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate >= DATE '2001-10-31' - INTERVAL 30 DAY""")
def recent_trips(spark, sf_dir):
    rows = last_days(table(spark, sf_dir, "lineitem"), "l_shipdate", dt.date(2001, 10, 31), 30)
    return project(rows, ["l_orderkey", "l_linenumber", "l_shipdate"])


@query("row_cap", """
SELECT LEAST(COUNT(*), 100) AS capped, LEAST(COUNT(*), 7) AS fewer, COUNT(*) AS uncapped FROM orders""")
def row_cap(spark, sf_dir):
    """Which rows a cap keeps is open, how many is not."""
    orders = project(table(spark, sf_dir, "orders"), ["o_orderkey"])
    counts = [row_count(cap(orders, n), name) for n, name in ((100, "capped"), (7, "fewer"), (None, "uncapped"))]
    return spark.range(1).select(
        *[counted.scalar().alias(counted.columns[0]) for counted in counts])


@query("first_rows", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def first_hundred(spark, sf_dir):
    return first_rows(project(table(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice"]), 100,
                      [F.desc("o_totalprice"), "o_orderkey"])


@query("dedup_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag,
       l_linestatus, l_shipdate
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
                 l_linestatus, l_shipdate) AS rn FROM lineitem)
WHERE rn = 1""")
def dedup_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return project(dedup_first(lines, keys, [c for c in lines.columns if c not in keys]),
                   [*keys, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                    "l_returnflag", "l_linestatus", "l_shipdate"])


@query("union_services", """
SELECT 'Green' AS service_type, l_orderkey, l_linenumber, l_suppkey FROM lineitem
WHERE l_linestatus = 'O'
UNION ALL
SELECT 'Yellow' AS service_type, l_orderkey, l_linenumber, l_suppkey FROM lineitem
WHERE l_linestatus <> 'O'""")
def union_services(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    green = project(lines.where("l_linestatus = 'O'"), ["l_orderkey", "l_linenumber", "l_suppkey"])
    yellow = project(lines.where("l_linestatus <> 'O'"), ["l_suppkey", "l_linenumber", "l_orderkey"])
    return union_tagged({"Green": green, "Yellow": yellow})


@query("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
       CAST(year(o_orderdate) AS VARCHAR) || '/Q' || CAST(quarter(o_orderdate) AS VARCHAR)
         AS year_quarter,
       CAST(o_orderdate AS DATE) AS day,
       CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month_start
FROM orders""")
def parts_of_dates(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", *date_parts("o_orderdate"), year_quarter("o_orderdate").alias("year_quarter"),
        day("o_orderdate").alias("day"), month_start("o_orderdate").alias("month_start"))


@query("time_diffs", """
SELECT event_id, CAST(floor(epoch(ts)) - epoch(TIMESTAMP '2024-01-01 00:00:30') AS BIGINT) AS seconds,
       date_diff('minute', TIMESTAMP '2024-01-01 00:00:30', ts) AS minutes,
       (floor(epoch(ts)) - epoch(TIMESTAMP '2024-01-01 00:00:30')) / 3600.0 AS hours
FROM events""")
def time_diffs(spark, sf_dir):
    start = F.lit(dt.datetime(2024, 1, 1, 0, 0, 30)).cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        "event_id", seconds_between(start, "ts").alias("seconds"),
        boundary_minutes(start, "ts").alias("minutes"), hours_between(start, "ts").alias("hours"))


@query("parse_timestamps", """
SELECT event_id, ts AS parsed, date_trunc('second', ts) AS whole_second,
       date_trunc('millisecond', ts) AS whole_milli
FROM events""")
def parse_timestamps(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    text = F.col("ts").cast("string")
    return events.select("event_id", parse_ts(text).alias("parsed"),
                         floor_second(parse_ts(text)).alias("whole_second"),
                         naive_utc(F.concat(text, F.lit("Z"))).alias("whole_milli"))


@query("safe_casts", """
SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS digit,
       TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
       COALESCE(NULLIF(o_orderstatus, 'P'), 'pending') AS status
FROM orders""")
def safe_casts(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", safe_int(F.substring("o_orderpriority", 1, 1)).alias("digit"),
        safe_int("o_orderpriority", text=True).alias("not_a_number"), numeric("o_totalprice").alias("price"),
        first_non_null(null_if("o_orderstatus", "P"), F.lit("pending")).alias("status"))


@query("text_funcs", """
SELECT p_partkey, replace(p_brand, 'Brand', 'Make') AS make, lower(p_type) AS type,
       format('{:,}', p_partkey) AS thousands, p_name || ' ' || p_brand AS label,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(p_partkey), '%Y-%m-%d %H:%M:%S') AS shown
FROM part""")
def text_funcs(spark, sf_dir):
    moment = F.timestamp_seconds(F.lit(1704067200) + F.col("p_partkey"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", replace_text("p_brand", "Brand", "Make").alias("make"),
        F.lower("p_type").alias("type"), thousands("p_partkey").alias("thousands"),
        concat_blank("p_name", F.lit(" "), "p_brand").alias("label"),
        display_ts(moment).alias("shown"))


@query("row_hash", f"""
WITH {TRIPS_SQL}
SELECT md5(CAST(vendorid AS VARCHAR) || CAST(pickup_datetime AS VARCHAR)
           || CAST(dropoff_datetime AS VARCHAR) || CAST(pulocationid AS VARCHAR)
           || CAST(dolocationid AS VARCHAR) || CAST(fare_amount AS VARCHAR)
           || CAST(trip_distance AS VARCHAR)) AS unique_row_id,
       'yellow_tripdata_all.csv' AS filename
FROM trips""")
def hashed_rows(spark, sf_dir):
    fields = ["vendorid", "pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid",
              "fare_amount", "trip_distance"]
    return trips(spark, sf_dir).select(row_hash(*fields).alias("unique_row_id"),
                                       F.lit("yellow_tripdata_all.csv").alias("filename"))


@query("surrogate_key", """
SELECT l_orderkey, l_linenumber,
       md5(CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_shipdate AS VARCHAR)) AS tripid
FROM lineitem""")
def surrogate_keys(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", surrogate_key("l_suppkey", "l_shipdate").alias("tripid"))


@query("dim_zones", f"WITH {ZONES_SQL} SELECT * FROM zones")
def dim_zones(spark, sf_dir):
    return models.dim_zones(raw_zones(spark, sf_dir))
