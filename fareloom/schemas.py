"""Declared schemas of the datasets and the renames that lead to the canonical column names.

Trip times are wall-clock values without a zone, so the batch side keeps them as ``timestamp_ntz``;
only the streaming side casts, because a watermark needs a zoned timestamp.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _TS = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                       T.TimestampNTZType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# The column order of the published monthly trip files.
YELLOW_CSV = _struct(
    VendorID=_S, tpep_pickup_datetime=_TS, tpep_dropoff_datetime=_TS, passenger_count=_I,
    trip_distance=_D, RatecodeID=_S, store_and_fwd_flag=_S, PULocationID=_S, DOLocationID=_S,
    payment_type=_I, fare_amount=_D, extra=_D, mta_tax=_D, tip_amount=_D, tolls_amount=_D,
    improvement_surcharge=_D, total_amount=_D, congestion_surcharge=_D,
)
GREEN_CSV = _struct(
    VendorID=_S, lpep_pickup_datetime=_TS, lpep_dropoff_datetime=_TS, store_and_fwd_flag=_S,
    RatecodeID=_S, PULocationID=_S, DOLocationID=_S, passenger_count=_I, trip_distance=_D,
    fare_amount=_D, extra=_D, mta_tax=_D, tip_amount=_D, tolls_amount=_D, ehail_fee=_D,
    improvement_surcharge=_D, total_amount=_D, payment_type=_I, trip_type=_I,
    congestion_surcharge=_D,
)
FHV_CSV = _struct(
    dispatching_base_num=_S, pickup_datetime=_TS, dropoff_datetime=_TS, PUlocationID=_I,
    DOlocationID=_I, SR_Flag=_I, Affiliated_base_number=_S,
)
TRIP_CSV = {"yellow": YELLOW_CSV, "green": GREEN_CSV, "fhv": FHV_CSV}

ZONES = _struct(locationid=_I, borough=_S, zone=_S, service_zone=_S)

RIDES_JSON = _struct(
    End_Lat=_D, End_Lon=_D, Fare_Amt=_D, Passenger_Count=_L, Payment_Type=_S, Rate_Code=_D,
    Start_Lat=_D, Start_Lon=_D, Tip_Amt=_D, Tolls_Amt=_D, Total_Amt=_D, Trip_Distance=_D,
    Trip_Dropoff_DateTime=_S, Trip_Pickup_DateTime=_S, mta_tax=_D, store_and_forward=_D,
    surcharge=_D, vendor_name=_S,
)

# One message of the green-trip topic.
TRIP_MESSAGE = _struct(
    lpep_pickup_datetime=T.TimestampType(), lpep_dropoff_datetime=T.TimestampType(),
    PULocationID=_I, DOLocationID=_I, passenger_count=_I, trip_distance=_D, tip_amount=_D,
)

# One line of the hourly activity files.
ACTIVITY_JSON = T.StructType([
    T.StructField("id", _S), T.StructField("type", _S),
    T.StructField("actor", _struct(id=_L, login=_S)),
    T.StructField("repo", _struct(id=_L, name=_S)),
    T.StructField("created_at", _S),
])

WATCH_COUNTS = T.StructType([
    T.StructField("name", _S, False), T.StructField("watch_count", _L, False),
])

# Warehouse exports of the trip tables use these older names.
EXPORT_RENAMES = {
    "vendor_id": "VendorID", "rate_code": "RatecodeID", "imp_surcharge": "improvement_surcharge",
    "pickup_location_id": "PULocationID", "dropoff_location_id": "DOLocationID",
}
RENAMES = {
    "yellow": {**EXPORT_RENAMES, "pickup_datetime": "tpep_pickup_datetime",
               "dropoff_datetime": "tpep_dropoff_datetime"},
    "green": {**EXPORT_RENAMES, "pickup_datetime": "lpep_pickup_datetime",
              "dropoff_datetime": "lpep_dropoff_datetime"},
    "fhv": {"PUlocationID": "pulocationid", "DOlocationID": "dolocationid",
            "tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime"},
}

# The service-independent trip shape that staging reads.
TRIP_COLUMNS = [
    "service_type", "vendorid", "pickup_datetime", "dropoff_datetime", "store_and_fwd_flag",
    "ratecodeid", "pulocationid", "dolocationid", "passenger_count", "trip_distance",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount", "payment_type", "trip_type",
]
MONEY_COLUMNS = [
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount",
]
