"""Catalog tables, merges and partitioned writes on the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import row_hash
from ..operators.aggregates import SKETCH_ERROR, distinct_between, distinct_sketches, row_count
from ..plans import activity as act
from ..plans import ingest
from ..plans.checked import load_checked
from ..plans.questions import distinct_pickups, vendors_between
from ..schemas import WATCH_COUNTS
from ..session import fresh_dir, fresh_name
from ..sinks import (IncrementalAggregate, append, create_as, ensure_table, materialize, replace, required,
                     write_clustered, write_partitioned)
from .mapping import EVENTS_SQL, TRIPS_SQL, nested_events, table, trips
from .registry import query


@query("ctas_count", "SELECT COUNT(*) AS rows FROM lineitem")
def ctas_count(spark, sf_dir):
    stored = create_as(fresh_name("lines"), table(spark, sf_dir, "lineitem"),
                       fresh_dir(spark, "lines"))
    return row_count(stored)


@query("insert_append", """
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders""")
def insert_append(spark, sf_dir):
    """A table of the early years; the later ones come with their columns in another order."""
    name = fresh_name("orders")
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    columns = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"]
    create_as(name, orders.where(early).select(*columns), fresh_dir(spark, "orders"))
    return append(name, orders.where(~early).select(*reversed(columns)))


@query("replace_table", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'""")
def replace_table(spark, sf_dir):
    name = fresh_name("staging")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    create_as(name, orders.where("o_orderstatus = 'F'"), fresh_dir(spark, "staging"))
    return replace(name, orders.where("o_orderstatus <> 'F'"))


@query("materialized_count", """
SELECT COUNT(*) AS rows, COUNT(DISTINCT l_suppkey) AS pickup_locations FROM lineitem""")
def materialized_count(spark, sf_dir):
    """The view is stored for one line status, then refreshed when its definition covers both."""
    name, root, wanted = fresh_name("mview"), fresh_dir(spark, "mview"), ["O"]

    def build():
        return table(spark, sf_dir, "lineitem").where(F.col("l_linestatus").isin(*wanted))

    materialize(spark, name, build, root)
    wanted.append("F")
    lines = materialize(spark, name, build, root).withColumnRenamed("l_suppkey", "pulocationid")
    counted = lines.agg(F.count("*").alias("rows"),
                        F.count_distinct("pulocationid").alias("pickup_locations"))
    return counted


@query("incremental_refresh", """
SELECT l_returnflag, l_linestatus, COUNT(*) AS lines, COUNT(l_suppkey) AS suppliers,
       CAST(SUM(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE) AS quantity, MIN(l_shipdate) AS first_shipped,
       MAX(l_extendedprice) AS dearest, ROUND(AVG(l_linenumber), 6) AS avg_line
FROM lineitem GROUP BY 1, 2""")
def incremental_refresh(spark, sf_dir):
    """Three loads of lines come into a folder one after the other; each refresh reads the new files alone."""
    lines, source = table(spark, sf_dir, "lineitem"), fresh_dir(spark, "arriving")
    stored = IncrementalAggregate(fresh_dir(spark, "states"), source, lines.schema, ["l_returnflag", "l_linestatus"], {
        "lines": ("count", F.lit(1)), "suppliers": ("count", "l_suppkey"),
        "quantity": ("sum", F.col("l_quantity").cast("decimal(15,2)")), "first_shipped": ("min", "l_shipdate"),
        "dearest": ("max", "l_extendedprice"), "avg_line": ("avg", "l_linenumber")})
    for load in range(3):
        lines.where(F.col("l_orderkey") % 3 == load).write.mode("append").parquet(source)
        stored.refresh(spark)
    return stored.read(spark).withColumn("avg_line", F.round("avg_line", 6))


@query("partition_prune_distinct", """
SELECT DISTINCT user_id AS vendorid FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'""")
def partition_prune_distinct(spark, sf_dir):
    """Events in one folder per day, in user order; the days outside the range are not read."""
    path = fresh_dir(spark, "by_day")
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("vendorid"), "ts", F.to_date("ts").alias("day"))
    write_partitioned(events, path, "day", ["vendorid"])
    return vendors_between(spark.read.parquet(path), "ts", "2024-01-10", "2024-01-20", "day")


@query("cluster_two_columns", """
SELECT 'price' AS by, COUNT(*) AS rows, CAST(SUM(o_orderkey) AS BIGINT) AS keys FROM orders
WHERE o_totalprice BETWEEN 100000 AND 110000
UNION ALL
SELECT 'date', COUNT(*), CAST(SUM(o_orderkey) AS BIGINT) FROM orders
WHERE o_orderdate >= TIMESTAMP '1995-03-01 00:00:00' AND o_orderdate < TIMESTAMP '1995-04-01 00:00:00'""")
def cluster_two_columns(spark, sf_dir):
    """Orders stored by interleaved bits of price and date: a filter on either skips most row groups."""
    path = fresh_dir(spark, "clustered")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    write_clustered(orders, path, ["o_totalprice", "o_orderdate"], rows_per_file=1000)
    stored = spark.read.schema(orders.schema).parquet(path)
    day = [F.lit(d).cast("timestamp_ntz") for d in ("1995-03-01", "1995-04-01")]
    found = {"price": stored.where(F.col("o_totalprice").between(100_000, 110_000)),
             "date": stored.where((F.col("o_orderdate") >= day[0]) & (F.col("o_orderdate") < day[1]))}
    parts = [df.agg(F.lit(by).alias("by"), F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys")) for by, df in found.items()]
    return parts[0].union(parts[1])


_RANGES = [("2024-01-01", "2024-01-07"), ("2024-01-05", "2024-01-20"), ("2024-01-01", "2024-01-31"), ("2023-01-01", "2023-12-31")]


@query("distinct_sketches", " UNION ALL ".join(f"""
SELECT '{a}' AS first_day, '{b}' AS last_day, COUNT(DISTINCT event_id) AS exact, TRUE AS within_bound FROM events
WHERE ts >= TIMESTAMP '{a} 00:00:00' AND ts < TIMESTAMP '{b} 00:00:00' + INTERVAL 1 DAY""" for a, b in _RANGES))
def stored_sketches(spark, sf_dir):
    """Sketches of the days are stored once and united over four ranges; the exact counts tell their error."""
    events, path = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), fresh_dir(spark, "sketches")
    distinct_sketches(events, "day", "event_id").write.parquet(path)
    sketches, days = spark.read.parquet(path), F.col("day")
    ranged = [F.lit(a).alias("first_day") for a, _ in _RANGES], [F.lit(b).alias("last_day") for _, b in _RANGES]
    exact = [events.where(days.between(F.lit(a).cast("date"), F.lit(b).cast("date"))).agg(F.count_distinct("event_id").alias("exact"))
             for a, b in _RANGES]
    near = [distinct_between(sketches, "day", a, b) for a, b in _RANGES]
    exact, near = (reduce(DataFrame.union, [df.select(first, last, "*") for df, first, last in zip(frames, *ranged)])
                   for frames in (exact, near))
    within = F.abs(F.col("distinct_values") - F.col("exact")) <= SKETCH_ERROR * F.col("exact")
    return exact.join(near, ["first_day", "last_day"]).select("first_day", "last_day", "exact", within.alias("within_bound"))


@query("ensure_table", f"""
WITH {EVENTS_SQL}
SELECT repo_name AS name, COUNT(*) AS watch_count FROM activity WHERE event_type = 'view'
GROUP BY 1""")
def ensured_table(spark, sf_dir):
    name, path = fresh_name("watch"), fresh_dir(spark, "watch")
    ensure_table(spark, name, WATCH_COUNTS, path)
    counts = act.watch_counts(nested_events(spark, sf_dir), "view")
    append(name, required(counts, WATCH_COUNTS))
    return ensure_table(spark, name, WATCH_COUNTS, path)


HASHED = ["vendorid", "pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid",
          "fare_amount", "trip_distance"]
_HASH_SQL = "md5(" + " || ".join(f"CAST({c} AS VARCHAR)" for c in HASHED) + ")"


@query("merge_insert_only", f"""
WITH {TRIPS_SQL},
hashed AS (SELECT *, {_HASH_SQL} AS unique_row_id FROM trips),
first_load AS (SELECT * FROM hashed WHERE pickup_datetime < TIMESTAMP '1998-06-15 00:00:00')
SELECT unique_row_id, 'first.csv' AS filename, strftime(pickup_datetime, '%Y-%m') AS pickup_month
FROM first_load
UNION ALL
SELECT unique_row_id, 'second.csv', strftime(pickup_datetime, '%Y-%m') FROM hashed
WHERE unique_row_id NOT IN (SELECT unique_row_id FROM first_load)""")
def merge_insert_only(spark, sf_dir):
    """A first file with the early trips, then a second one that holds all trips, into a table bucketed by row id."""
    name, path = fresh_name("merged"), fresh_dir(spark, "merged")
    rows = ingest.with_month(
        trips(spark, sf_dir).withColumn("unique_row_id", row_hash(*HASHED)), "pickup_datetime")
    early = rows.where(F.col("pickup_datetime") < F.lit("1998-06-15").cast("timestamp_ntz"))

    def load(staging, file):
        return ingest.store_bucketed(name, staging.select("unique_row_id", F.lit(file).alias("filename"), ingest.PART), path, buckets=8)

    load(early, "first.csv")
    return load(rows, "second.csv")


_RULES = {"shipped": "l_shipdate >= TIMESTAMP '1993-01-01 00:00:00'", "flag": "l_returnflag IN ('A', 'N')", "discount": "l_discount > 0"}


@query("load_quarantine", f"""
WITH checked AS (
  SELECT *, concat_ws(',', {", ".join(f"CASE WHEN NOT ({rule}) THEN '{name}' END" for name, rule in _RULES.items())}) AS reasons
  FROM lineitem)
SELECT reasons, COUNT(*) AS rows, CAST(SUM(l_orderkey) AS BIGINT) AS keys FROM checked GROUP BY 1""")
def load_quarantine(spark, sf_dir):
    """Lines are checked while they are loaded; the table and the quarantine together are all of them."""
    loaded, aside = fresh_dir(spark, "loaded"), fresh_dir(spark, "quarantine")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag", "l_discount")
    rules = {"shipped": F.col("l_shipdate") >= F.lit("1993-01-01").cast("timestamp_ntz"), "flag": F.col("l_returnflag").isin("A", "N"),
             "discount": F.col("l_discount") > 0}
    load_checked(lines, rules, loaded, aside, max_bad=1 << 62)
    good = spark.read.schema(lines.schema).parquet(loaded).withColumn("reasons", F.lit(""))
    bad = spark.read.parquet(aside).withColumn("reasons", F.array_join("reasons", ","))
    return good.union(bad).groupBy("reasons").agg(F.count("*").alias("rows"), F.sum("l_orderkey").alias("keys"))
