"""Trip models: staging, dimensions and facts.

Staged models are views, dimensions and facts are tables when stored through ``Layers``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (date_parts, map_codes, numeric, replace_text, safe_ints,
                         surrogate_key)
from ..functions.values import PAYMENT_NAMES
from ..operators.aggregates import union_all
from ..operators.filters import cap, where_ne, where_not_null
from ..operators.joins import role_join
from ..operators.windows import dedup_first
from ..schemas import MONEY_COLUMNS, TRIP_COLUMNS
from ..sinks.tables import model

ROLES = {"pickup": "pickup_locationid", "dropoff": "dropoff_locationid"}
# The time comes first: it tells most rows apart, so sorting seldom looks at the other columns.
DEDUP_KEYS = ("pickup_datetime", "vendorid", "service_type")
ACCEPTED_PAYMENTS = [1, 2, 3, 4, 5, 6]

_PREFIX = {"Green": "lpep", "Yellow": "tpep"}


def trips_of(raw: DataFrame, service: str) -> DataFrame:
    """The monthly rows of one service in the shape common to both.

    Yellow trips are always hailed on the street (type 1) and have no e-hail fee.
    """
    prefix = _PREFIX[service]
    extra = {"service_type": F.lit(service),
             "pickup_datetime": F.col(f"{prefix}_pickup_datetime"),
             "dropoff_datetime": F.col(f"{prefix}_dropoff_datetime")}
    if service == "Yellow":
        extra |= {"trip_type": F.lit(1), "ehail_fee": F.lit(0.0)}
    return raw.select(*[(extra[c] if c in extra else F.col(c)).alias(c) for c in TRIP_COLUMNS])


def all_trips(green: DataFrame, yellow: DataFrame) -> DataFrame:
    return union_all([trips_of(green, "Green"), trips_of(yellow, "Yellow")])


@model("view")
def stage_trips(trips: DataFrame, keys: Sequence[str] = DEDUP_KEYS,
                sample_rows: int | None = None) -> DataFrame:
    """Trips with a vendor, one per key, typed and described.

    Both services are staged in one pass: the service is part of the key, so they do not mix. The kept
    trip is the least one in the order of all other columns.
    """
    order = [c for c in TRIP_COLUMNS if c not in keys]
    first = dedup_first(where_not_null(trips, "vendorid"), keys, order)
    staged = first.select(
        "service_type",
        surrogate_key("vendorid", "pickup_datetime").alias("tripid"),
        *safe_ints(first, {"vendorid": "vendorid", "ratecodeid": "ratecodeid",
                           "pulocationid": "pickup_locationid",
                           "dolocationid": "dropoff_locationid"}),
        F.col("pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("dropoff_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
        "store_and_fwd_flag",
        *safe_ints(first, {"passenger_count": "passenger_count"}),
        numeric("trip_distance").alias("trip_distance"),
        *safe_ints(first, {"trip_type": "trip_type"}),
        *[numeric(c).alias(c) for c in MONEY_COLUMNS],
        *safe_ints(first, {"payment_type": "_code"}),
    )
    described = staged.select(
        *[c for c in staged.columns if c != "_code"],
        F.coalesce("_code", F.lit(0)).alias("payment_type"),
        map_codes("_code", PAYMENT_NAMES, "EMPTY").alias("payment_type_description"))
    return cap(described, sample_rows)


def stage_service(raw: DataFrame, service: str, sample_rows: int | None = None) -> DataFrame:
    """Staged trips of one service, from its monthly rows."""
    return stage_trips(trips_of(raw, service), sample_rows=sample_rows).drop("service_type")


@model("view")
def stage_fhv(raw: DataFrame) -> DataFrame:
    """For-hire trips with a dispatching base; they are not deduplicated.

    Base numbers are cast to integers where they can be; the text stays beside them.
    """
    return where_not_null(raw, "dispatching_base_num").select(
        surrogate_key("dispatching_base_num", "pickup_datetime").alias("tripid"),
        *safe_ints(raw, {"dispatching_base_num": "dispatchid", "affiliated_base_number": "affilid",
                         "pulocationid": "pickup_locationid",
                         "dolocationid": "dropoff_locationid"}),
        F.col("pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("dropoff_datetime").cast("timestamp_ntz").alias("dropoff_datetime"),
        F.col("sr_flag"),
        F.col("dispatching_base_num"),
    )


@model("table")
def dim_zones(zones: DataFrame) -> DataFrame:
    return zones.select("locationid", "borough", "zone",
                        replace_text("service_zone", "Boro", "Green").alias("service_zone"))


def known_zones(zones: DataFrame) -> DataFrame:
    return where_ne(zones, "borough", "Unknown")


FACT_COLUMNS = [
    "tripid", "vendorid", "service_type", "ratecodeid", "pickup_locationid", "pickup_borough",
    "pickup_zone", "dropoff_locationid", "dropoff_borough", "dropoff_zone", "pickup_datetime",
    "dropoff_datetime", "store_and_fwd_flag", "passenger_count", "trip_distance", "trip_type",
    *MONEY_COLUMNS, "payment_type", "payment_type_description",
]


@model("table")
def fact_trips(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """Staged trips between known zones, with borough and zone of both ends."""
    joined = role_join(staged, known_zones(zones), ROLES, "locationid", ["borough", "zone"])
    return joined.select(*FACT_COLUMNS)


@model("table")
def dim_fhv_trips(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """Staged for-hire trips between known zones, with year and month of the pickup."""
    joined = role_join(staged, known_zones(zones), ROLES, "locationid", ["borough", "zone"])
    year, month, _ = date_parts("pickup_datetime")
    return joined.select(
        year, month, "pickup_datetime", "dropoff_datetime", "tripid", "dispatchid", "affilid",
        "pickup_locationid", "dropoff_locationid", "sr_flag", "pickup_borough", "pickup_zone",
        "dropoff_borough", "dropoff_zone")
