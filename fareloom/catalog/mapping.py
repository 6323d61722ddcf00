"""The test tables in the shape of trips, zones and activity events; the same as SQL text.

A trip is an order line: it starts on the order date and ends on the ship date, from the nation of the
supplier to the nation of the customer. Lines with status O are green, the others yellow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import MONEY_COLUMNS, TRIP_COLUMNS


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is taken from the file once; asking again would be a job per read."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _money() -> dict[str, Column]:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(3,2)")
    tax = F.col("l_tax").cast("decimal(3,2)")
    return {
        "fare_amount": price, "extra": price * discount, "mta_tax": tax, "tip_amount": price * tax,
        "tolls_amount": discount, "ehail_fee": F.lit(0).cast("decimal(4,2)"),
        "improvement_surcharge": F.lit("0.30").cast("decimal(4,2)"),
        "total_amount": price * (1 - discount) * (1 + tax),
    }


def _line_columns() -> dict[str, Column]:
    return {
        "service_type": F.when(F.col("l_linestatus") == "O", "Green").otherwise("Yellow"),
        "vendorid": F.col("l_suppkey"), "dropoff_datetime": F.col("l_shipdate"),
        "store_and_fwd_flag": F.col("l_returnflag"), "ratecodeid": F.col("l_linenumber"),
        "passenger_count": F.col("l_linenumber"),
        "trip_distance": F.col("l_quantity").cast("decimal(15,2)"),
        "trip_type": F.when(F.col("l_returnflag") == "R", 2).otherwise(1),
        **_money(),
    }


def trips(spark: SparkSession, sf_dir: str, start: bool = True, pickup: bool = True,
          dropoff: bool = True, by_month: bool = False) -> DataFrame:
    """Order lines as trips. Parts that a question does not need are left out with their join:
    ``start`` is the order (time and payment), ``pickup`` the supplier, ``dropoff`` the customer.

    The customer is joined to the orders and the supplier to the lines before lines and orders meet, so that a
    condition on either location thins them out first.
    Lines and orders both grow with the data, so their join is asked to be a merge join, whose hot keys
    adaptive execution splits; a broadcast of either would only ever suit small data. ``by_month`` brings trips of a
    month together, as columns of the tables, of which there are fewer than of a trip.
    """
    rows, columns = table(spark, sf_dir, "lineitem"), _line_columns()
    if pickup:
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        rows = rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        columns["pulocationid"] = F.col("s_nationkey")
    if start or dropoff:
        orders = table(spark, sf_dir, "orders")
        columns["pickup_datetime"] = F.col("o_orderdate")
        columns["payment_type"] = F.substring("o_orderpriority", 1, 1)
        if dropoff:
            customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            columns["dolocationid"] = F.col("c_nationkey")
        rows = rows.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    if by_month:
        rows = rows.select("l_linestatus", "l_suppkey", "l_shipdate", "l_returnflag", "l_linenumber", "l_quantity",
                           "l_extendedprice", "l_discount", "l_tax", "s_nationkey", "c_nationkey", "o_orderdate",
                           "o_orderpriority", F.trunc("o_orderdate", "MM").alias("_month")).hint("rebalance", "_month")
    return rows.select(*[columns[c].alias(c) for c in TRIP_COLUMNS if c in columns])


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("locationid"),
        F.when(F.col("r_name") == "MIDDLE EAST", "Unknown").otherwise(F.col("r_name"))
        .alias("borough"),
        F.col("n_name").alias("zone"), F.concat(F.lit("Boro "), "r_name").alias("service_zone"))


def raw_fhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as for-hire trips; the affiliated base is text that is no number."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(F.col("l_suppkey").cast("string").alias("dispatching_base_num"),
                F.col("o_orderdate").alias("pickup_datetime"),
                F.col("l_shipdate").alias("dropoff_datetime"),
                F.col("s_nationkey").alias("pulocationid"),
                F.col("c_nationkey").alias("dolocationid"),
                F.col("l_linenumber").alias("sr_flag"),
                F.col("s_name").alias("affiliated_base_number"))
    )


def nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity events with nested actor and repository; the repository is ``k`` of the payload."""
    k = F.from_json("props", "k bigint").getField("k")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("type"),
        F.struct(F.col("user_id").alias("id"),
                 F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("login"))
        .alias("actor"),
        F.struct(k.alias("id"), F.concat(F.lit("repo/"), k.cast("string")).alias("name"))
        .alias("repo"),
        F.col("ts").alias("created_at"))


_PRICE = "CAST(l_extendedprice AS DECIMAL(15,2))"
_DISCOUNT = "CAST(l_discount AS DECIMAL(4,2))"
_TAX = "CAST(l_tax AS DECIMAL(4,2))"

TRIPS_SQL = f"""trips AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'Green' ELSE 'Yellow' END AS service_type,
         l_suppkey AS vendorid, o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
         l_returnflag AS store_and_fwd_flag, l_linenumber AS ratecodeid,
         s_nationkey AS pulocationid, c_nationkey AS dolocationid,
         l_linenumber AS passenger_count, CAST(l_quantity AS DECIMAL(15,2)) AS trip_distance,
         {_PRICE} AS fare_amount, {_PRICE} * {_DISCOUNT} AS extra, {_TAX} AS mta_tax,
         {_PRICE} * {_TAX} AS tip_amount, {_DISCOUNT} AS tolls_amount,
         CAST(0 AS DECIMAL(4,2)) AS ehail_fee, CAST(0.30 AS DECIMAL(4,2)) AS improvement_surcharge,
         {_PRICE} * (1 - {_DISCOUNT}) * (1 + {_TAX}) AS total_amount,
         substr(o_orderpriority, 1, 1) AS payment_type,
         CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS trip_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""

_PAYMENT_SQL = """CASE TRY_CAST(payment_type AS INTEGER) WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash'
    WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip'
    ELSE 'EMPTY' END"""

_REST = ", ".join(c for c in TRIP_COLUMNS
                  if c not in ("service_type", "vendorid", "pickup_datetime"))

STAGED_SQL = f"""{TRIPS_SQL},
numbered AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY service_type, vendorid, pickup_datetime
                               ORDER BY {_REST}) AS rn
  FROM trips WHERE vendorid IS NOT NULL),
staged AS (
  SELECT service_type,
         md5(CAST(vendorid AS VARCHAR) || '-' || CAST(pickup_datetime AS VARCHAR)) AS tripid,
         CAST(vendorid AS INTEGER) AS vendorid, CAST(ratecodeid AS INTEGER) AS ratecodeid,
         pulocationid AS pickup_locationid, dolocationid AS dropoff_locationid,
         pickup_datetime, dropoff_datetime, store_and_fwd_flag, passenger_count,
         trip_distance, trip_type, {", ".join(MONEY_COLUMNS)},
         COALESCE(TRY_CAST(payment_type AS INTEGER), 0) AS payment_type,
         {_PAYMENT_SQL} AS payment_type_description
  FROM numbered WHERE rn = 1)"""

ZONES_SQL = """zones AS (
  SELECT n_nationkey AS locationid,
         CASE WHEN r_name = 'MIDDLE EAST' THEN 'Unknown' ELSE r_name END AS borough,
         n_name AS zone, replace('Boro ' || r_name, 'Boro', 'Green') AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

FACT_SQL = f"""{STAGED_SQL},
{ZONES_SQL},
fact AS (
  SELECT s.*, p.borough AS pickup_borough, p.zone AS pickup_zone,
         d.borough AS dropoff_borough, d.zone AS dropoff_zone
  FROM staged s
  JOIN zones p ON s.pickup_locationid = p.locationid AND p.borough <> 'Unknown'
  JOIN zones d ON s.dropoff_locationid = d.locationid AND d.borough <> 'Unknown')"""

FHV_SQL = f"""{ZONES_SQL},
fhv AS (
  SELECT md5(CAST(l_suppkey AS VARCHAR) || '-' || CAST(o_orderdate AS VARCHAR)) AS tripid,
         CAST(l_suppkey AS INTEGER) AS dispatchid, TRY_CAST(s_name AS INTEGER) AS affilid,
         s_nationkey AS pickup_locationid, c_nationkey AS dropoff_locationid,
         o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
         l_linenumber AS sr_flag, CAST(l_suppkey AS VARCHAR) AS dispatching_base_num
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  WHERE l_suppkey IS NOT NULL),
dim_fhv AS (
  SELECT CAST(year(pickup_datetime) AS INTEGER) AS year,
         CAST(month(pickup_datetime) AS INTEGER) AS month,
         f.* EXCLUDE (dispatching_base_num),
         p.borough AS pickup_borough, p.zone AS pickup_zone,
         d.borough AS dropoff_borough, d.zone AS dropoff_zone
  FROM fhv f
  JOIN zones p ON f.pickup_locationid = p.locationid AND p.borough <> 'Unknown'
  JOIN zones d ON f.dropoff_locationid = d.locationid AND d.borough <> 'Unknown')"""

EVENTS_SQL = """activity AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, user_id AS actor_id,
         'user_' || CAST(user_id AS VARCHAR) AS actor_login,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS repo_id,
         'repo/' || json_extract_string(props, '$.k') AS repo_name, ts,
         date_trunc('second', ts) AS created_at
  FROM events)"""

MONEY_AS_DOUBLE = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MONEY_COLUMNS)
