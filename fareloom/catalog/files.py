"""File formats: the tables are written by Spark in the wanted format, then read by the scan under test."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import activity as act
from ..plans import ingest, rides
from ..plans import trips as models
from ..schemas import FHV_CSV, GREEN_CSV, RIDES_JSON, YELLOW_CSV
from ..session import fresh_dir, fresh_name
from ..sinks import json_payload, write_csv, write_parquet
from ..sources import (canonical, describe, external_table, list_tables, preview, register, scan_csv,
                       scan_events_json, scan_json_pages, scan_months, snake_case)
from ..sources.files import CORRUPT
from .mapping import EVENTS_SQL, TRIPS_SQL, nested_events, raw_fhv, table, trips
from .registry import query


@query("csv_roundtrip", """
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_shipdate FROM lineitem""")
def csv_roundtrip(spark, sf_dir):
    path = fresh_dir(spark, "csv")
    write_csv(table(spark, sf_dir, "lineitem"), path,
              ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"])
    # Small keys are inferred as int.
    return scan_csv(spark, path, infer=True).withColumn(
        "l_orderkey", F.col("l_orderkey").cast("bigint"))


@query("csv_declared", """
SELECT CAST(l_suppkey AS VARCHAR) AS dispatching_base_num, o_orderdate AS pickup_datetime,
       l_shipdate AS dropoff_datetime, s_nationkey AS pulocationid, c_nationkey AS dolocationid,
       l_linenumber AS sr_flag, s_name AS affiliated_base_number
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey""")
def csv_declared(spark, sf_dir):
    path = fresh_dir(spark, "fhv")
    columns = ["dispatching_base_num", "pickup_datetime", "dropoff_datetime", "pulocationid",
               "dolocationid", "sr_flag", "affiliated_base_number"]
    write_csv(raw_fhv(spark, sf_dir), path, columns, codec="gzip")
    return scan_csv(spark, path, FHV_CSV).toDF(*columns)


def yellow_rows(spark, sf_dir):
    """Trips as rows of the monthly yellow files."""
    rows = trips(spark, sf_dir)
    names = {"VendorID": "vendorid", "tpep_pickup_datetime": "pickup_datetime",
             "tpep_dropoff_datetime": "dropoff_datetime", "RatecodeID": "ratecodeid",
             "PULocationID": "pulocationid", "DOLocationID": "dolocationid",
             "congestion_surcharge": "ehail_fee"}
    return rows.select(*[F.col(names.get(f.name, f.name)).cast(f.dataType).alias(f.name)
                         for f in YELLOW_CSV.fields])


MONTHS = [f"{year}-{month:02d}" for year in range(1995, 2003) for month in range(1, 13)]


@query("scan_months", """
SELECT 'yellow_tripdata_' || strftime(o_orderdate, '%Y-%m') || '.csv.gz' AS filename,
       COUNT(*) AS trips, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS fares
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def monthly_files(spark, sf_dir):
    root = fresh_dir(spark, "months")
    name = F.concat(F.lit("yellow_tripdata_"), F.date_format("tpep_pickup_datetime", "yyyy-MM"),
                    F.lit(".csv.gz"))
    (yellow_rows(spark, sf_dir).withColumn("file", name).hint("rebalance", "file").write
     .partitionBy("file").option("header", True).option("compression", "gzip").csv(root))
    # The list covers all years of the tables; a small one has no trip in some month.
    rows = scan_months(spark, root, "yellow", MONTHS, template="file={kind}_tripdata_{month}.csv.gz", gaps=True)
    return rows.groupBy(F.regexp_replace("filename", "^file=", "").alias("filename")).agg(
        F.count("*").alias("trips"),
        F.sum(F.col("fare_amount").cast("decimal(18,2)")).alias("fares"))


@query("csv_bad_rows", """
SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
       CASE WHEN l_returnflag <> 'R' AND l_linestatus <> 'F' THEN CAST(l_quantity AS INTEGER) END
         AS quantity,
       CASE WHEN l_returnflag <> 'R' THEN l_linestatus END AS l_linestatus,
       l_returnflag = 'R' OR l_linestatus = 'F' AS is_bad
FROM lineitem""")
def csv_bad_rows(spark, sf_dir):
    """Returned lines are cut short; finished ones have a text in the number column."""
    quantity = F.when(F.col("l_linestatus") == "F", F.concat(F.lit("n"), "l_quantity")).otherwise(
        F.col("l_quantity").cast("int").cast("string"))
    whole = [F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")]
    line = F.when(F.col("l_returnflag") == "R", F.concat_ws(",", *whole)).otherwise(
        F.concat_ws(",", *whole, quantity, "l_linestatus"))
    path = fresh_dir(spark, "bad")
    # One text column without quotes is the raw line; its name is the header of every file.
    header = "l_orderkey,l_linenumber,quantity,l_linestatus"
    (table(spark, sf_dir, "lineitem").select(line.alias(header)).write.option("header", True)
     .option("quote", "").option("sep", "\u0001").csv(path))
    schema = T.StructType().add("l_orderkey", T.LongType()).add(
        "l_linenumber", T.IntegerType()).add("quantity", T.IntegerType()).add(
        "l_linestatus", T.StringType())
    rows = scan_csv(spark, path, schema, bad_rows="keep")
    return rows.withColumn("is_bad", F.col(CORRUPT).isNotNull()).drop(CORRUPT)


@query("json_events", f"""
WITH {EVENTS_SQL}
SELECT event_id AS id, event_type AS type, actor_id, actor_login, repo_id, repo_name,
       date_trunc('millisecond', ts) AS created_at
FROM activity""")
def json_events(spark, sf_dir):
    path = fresh_dir(spark, "json")
    text = F.concat(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    (nested_events(spark, sf_dir).withColumn("created_at", text).write
     .option("compression", "gzip").json(path))
    events = act.land_events(scan_events_json(spark, path))
    return events.select("id", "type", F.col("actor.id").alias("actor_id"),
                         F.col("actor.login").alias("actor_login"), F.col("repo.id").alias("repo_id"),
                         F.col("repo.name").alias("repo_name"), "created_at")


def ride_records(spark, sf_dir):
    """Events as ride records: a ride starts at the event and lasts ``value`` minutes."""
    start = F.unix_seconds(F.col("ts").cast("timestamp"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    given = {
        "Trip_Pickup_DateTime": F.date_format("ts", fmt),
        "Trip_Dropoff_DateTime": F.date_format(
            F.timestamp_seconds(start + F.floor(F.col("value") * 60)), fmt),
        "Passenger_Count": F.col("event_id"), "Payment_Type": F.col("event_type"),
        "Total_Amt": F.col("value"),
    }
    return table(spark, sf_dir, "events").select(
        "event_id", *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in RIDES_JSON.fields])


def write_pages(spark, sf_dir):
    """Pages of 1,000 records, then an empty page, then a stale page that must not be read.

    The event id is a row number, so a page never holds more than its 1,000 records.
    """
    root = fresh_dir(spark, "pages")
    page = F.floor(F.col("event_id") / 1000) + 1
    records = F.to_json(F.collect_list(F.struct(*RIDES_JSON.fieldNames())),
                        {"ignoreNullFields": "false"})
    filled = ride_records(spark, sf_dir).groupBy(page.alias("page")).agg(records.alias("value"))
    filled.write.partitionBy("page").text(root)
    last = table(spark, sf_dir, "events").agg(
        (F.floor(F.max("event_id") / 1000) + 1).alias("page"))
    stale = '[{"Passenger_Count": -1}]'
    after = last.select(F.inline(F.array(
        F.struct((F.col("page") + 1).alias("page"), F.lit("[]").alias("value")),
        F.struct((F.col("page") + 2).alias("page"), F.lit(stale).alias("value")))))
    after.write.mode("append").partitionBy("page").text(root)
    return root


def load_pages(spark, sf_dir):
    pages = scan_json_pages(spark, write_pages(spark, sf_dir), RIDES_JSON,
                            page_pattern=r"page=(\d+)")
    return rides.load_rides(pages.drop("page"))


@query("json_pages", """
SELECT event_id AS passenger_count, event_type AS payment_type, value AS total_amt,
       date_trunc('second', ts) AS trip_pickup_date_time FROM events""")
def json_pages(spark, sf_dir):
    return load_pages(spark, sf_dir).select("passenger_count", "payment_type", "total_amt",
                                            "trip_pickup_date_time")


@query("avg_duration_minutes", """
SELECT ROUND(AVG(date_diff('minute', date_trunc('second', ts), date_trunc('second', ts)
         + to_seconds(CAST(floor(value * 60) AS BIGINT)))), 6) AS avg_minutes
FROM events""")
def avg_duration_minutes(spark, sf_dir):
    return rides.avg_duration_minutes(load_pages(spark, sf_dir)).withColumn(
        "avg_minutes", F.round("avg_minutes", 6))


@query("external_count", "SELECT COUNT(*) AS rows FROM lineitem")
def external_count(spark, sf_dir):
    lines = external_table(spark, fresh_name("lines"), f"{sf_dir}/lineitem.parquet")
    return lines.agg(F.count("*").alias("rows"))


@query("sql_with_args", """
SELECT l_returnflag, COUNT(*) AS lines FROM lineitem
WHERE l_shipdate >= DATE '1998-01-01' AND l_linestatus = 'O' GROUP BY 1""")
def sql_with_args(spark, sf_dir):
    view = fresh_name("lines")
    register(view, table(spark, sf_dir, "lineitem"))
    return spark.sql(
        f"SELECT l_returnflag, count(*) AS lines FROM {view} "
        "WHERE l_shipdate >= :first AND l_linestatus = :status GROUP BY l_returnflag",
        args={"first": dt.date(1998, 1, 1), "status": "O"})


_LINE_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}


@query("describe_table", " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, COUNT({c}) AS non_null, "
    "COUNT(*) AS rows FROM lineitem" for i, (c, t) in enumerate(_LINE_TYPES.items(), 1)))
def describe_table(spark, sf_dir):
    return describe(table(spark, sf_dir, "lineitem"))


@query("rename_columns", """
SELECT l_suppkey AS vendor_id, l_shipdate AS tpep_pickup_datetime, l_linenumber AS ratecode_id,
       l_partkey AS pulocation_id, l_orderkey AS trip_order_key FROM lineitem""")
def rename_columns(spark, sf_dir):
    export = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("vendor_id"), F.col("l_shipdate").alias("pickup_datetime"),
        F.col("l_linenumber").alias("rate_code"), F.col("l_partkey").alias("pickup_location_id"),
        F.col("l_orderkey").alias("Trip_OrderKey"))
    return snake_case(canonical(export, "yellow"))


@query("repartition_write", """
SELECT COUNT(*) AS rows, CAST(4 AS BIGINT) AS files, SUM(CAST(l_quantity AS BIGINT))::BIGINT AS quantity
FROM lineitem""")
def repartition_write(spark, sf_dir):
    path = fresh_dir(spark, "four")
    write_parquet(table(spark, sf_dir, "lineitem"), path, files=4)
    return spark.read.parquet(path).agg(
        F.count("*").alias("rows"), F.count_distinct("_metadata.file_name").alias("files"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


@query("gzip_parquet", """
SELECT event_id, user_id, event_type, value, props, date_trunc('millisecond', ts) AS ts
FROM events""")
def gzip_parquet(spark, sf_dir):
    path = fresh_dir(spark, "gzip")
    write_parquet(table(spark, sf_dir, "events"), path, codec="gzip", milliseconds=["ts"])
    return spark.read.parquet(path)


@query("json_payload", """
SELECT '{"lpep_pickup_datetime":"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
       || '","lpep_dropoff_datetime":"' || strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
       || '","PULocationID":' || l_suppkey || ',"DOLocationID":' || l_partkey
       || ',"passenger_count":' || COALESCE(NULLIF(l_linenumber, 7), 0)
       || ',"trip_distance":' || CAST(l_quantity AS INTEGER)
       || ',"tip_amount":' || CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) || '}' AS value,
       l_suppkey AS pulocationid, COALESCE(NULLIF(l_linenumber, 7), 0) AS passengers,
       o_orderdate AS pickup
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def json_messages(spark, sf_dir):
    """Line 7 has no passenger count, which the message gives as 0; then messages are decoded again."""
    rows = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderdate").alias("lpep_pickup_datetime"),
        F.col("l_shipdate").alias("lpep_dropoff_datetime"),
        F.col("l_suppkey").alias("PULocationID"), F.col("l_partkey").alias("DOLocationID"),
        F.nullif("l_linenumber", F.lit(7)).alias("passenger_count"),
        F.col("l_quantity").cast("int").alias("trip_distance"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("tip_amount"))
    fields = "lpep_pickup_datetime timestamp_ntz, PULocationID bigint, passenger_count int"
    parsed = F.from_json("value", fields, {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"})
    return json_payload(rows).withColumn("m", parsed).select(
        "value", F.col("m.PULocationID").alias("pulocationid"),
        F.col("m.passenger_count").alias("passengers"),
        F.col("m.lpep_pickup_datetime").alias("pickup"))


def _write_months(rows, kind, pickup, root, together=False):
    """Monthly files of one kind as they are published: gzip CSV, one name per month of the pickup. ``together``: rows
    of a month lie together already."""
    name = F.concat(F.lit(f"{kind}_tripdata_"), F.date_format(pickup, "yyyy-MM"), F.lit(".csv.gz"))
    rows = rows.withColumn("file", name)
    ((rows if together else rows.hint("rebalance", "file")).write.partitionBy("file")
     .option("header", True).option("compression", "gzip").csv(root))


_MONTHLY = "file={kind}_tripdata_{month}.csv.gz"


@query("ingest_fhv", """
SELECT CAST(l_suppkey AS VARCHAR) AS dispatching_base_num, o_orderdate AS pickup_datetime,
       l_shipdate AS dropoff_datetime, s_nationkey AS pulocationid, c_nationkey AS dolocationid,
       l_linenumber AS sr_flag, s_name AS affiliated_base_number,
       strftime(o_orderdate, '%Y-%m') AS pickup_month
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey""")
def ingest_fhv(spark, sf_dir):
    """For-hire files of all months, loaded twice: each file is appended once."""
    root, path = fresh_dir(spark, "fhv_files"), fresh_dir(spark, "fhv")
    columns = [f.name for f in FHV_CSV.fields]
    rows = raw_fhv(spark, sf_dir)
    _write_months(rows.select(*[F.col(c.lower()).alias(c) for c in columns]), "fhv", "pickup_datetime", root)
    for _ in range(2):
        ingest.ingest_months(spark, root, "fhv", MONTHS, path, _MONTHLY, gaps=True)
    schema = T.StructType([*FHV_CSV.fields, T.StructField("filename", T.StringType()),
                           T.StructField(ingest.PART, T.StringType())])
    return ingest.stored(spark, path, schema).drop("filename").toDF(*[c.lower() for c in columns], ingest.PART)


@query("ingest_yellow_green", f"""
WITH {TRIPS_SQL}
SELECT service_type, CAST(EXTRACT(year FROM pickup_datetime) AS INTEGER) AS year, COUNT(*) AS trips,
       COUNT(DISTINCT vendorid) AS vendors, CAST(SUM(CAST(fare_amount AS DECIMAL(18,2))) AS DOUBLE) AS fares,
       SUM(CASE WHEN service_type = 'Yellow' THEN 1 ELSE trip_type END)::BIGINT AS trip_types
FROM trips GROUP BY 1, 2""")
def ingest_yellow_green(spark, sf_dir):
    """Monthly files of both services through the merge and into the shape that staging reads."""
    rows, out = trips(spark, sf_dir, by_month=True), {}
    for service, fields in (("yellow", YELLOW_CSV), ("green", GREEN_CSV)):
        prefix = {"yellow": "tpep", "green": "lpep"}[service]
        names = {"VendorID": "vendorid", f"{prefix}_pickup_datetime": "pickup_datetime",
                 f"{prefix}_dropoff_datetime": "dropoff_datetime", "RatecodeID": "ratecodeid",
                 "PULocationID": "pulocationid", "DOLocationID": "dolocationid", "congestion_surcharge": "ehail_fee"}
        own = rows.where(F.lower("service_type") == service).select(
            *[F.col(names.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in fields.fields])
        root, path = fresh_dir(spark, f"{service}_files"), fresh_dir(spark, service)
        _write_months(own, service, f"{prefix}_pickup_datetime", root, together=True)
        for _ in range(2):
            ingest.ingest_months(spark, root, service, MONTHS, path, _MONTHLY, gaps=True)
        out[service] = spark.read.parquet(path)
    both = models.all_trips(out["green"], out["yellow"])
    return both.groupBy("service_type", F.year("pickup_datetime").alias("year")).agg(
        F.count("*").alias("trips"), F.count_distinct("vendorid").alias("vendors"),
        F.sum(F.col("fare_amount").cast("decimal(18,2)")).alias("fares"), F.sum("trip_type").alias("trip_types"))


@query("list_and_preview", """
SELECT 'orders' AS "table", o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5""")
def list_and_preview(spark, sf_dir):
    """A registered view is found by name, and its first rows are shown."""
    view = fresh_name("orders")
    register(view, table(spark, sf_dir, "orders"))
    name = list_tables(spark, f"{view}*").where("isTemporary").select("table").scalar()
    return preview(spark.table(view).select("o_orderkey", "o_totalprice"), 5, ["o_orderkey"]).withColumn(
        "table", F.when(name == view, "orders"))
