"""Rows as JSON messages of a topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The fields of a green-trip message.
MESSAGE_COLUMNS = [
    "lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID", "DOLocationID",
    "passenger_count", "trip_distance", "tip_amount",
]


def json_payload(df: DataFrame, columns: Sequence[str] = tuple(MESSAGE_COLUMNS),
                 zero_if_null: Sequence[str] = ("passenger_count",)) -> DataFrame:
    """One column ``value`` with a JSON object per row; the named counts are 0 where null."""
    fields = [F.coalesce(F.col(c), F.lit(0)).alias(c) if c in zero_if_null else F.col(c)
              for c in columns]
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ss",
               "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    return df.select(F.to_json(F.struct(*fields), options).alias("value"))


def publish_json(df: DataFrame, servers: str, topic: str, **payload) -> None:
    """Send the rows, tasks in parallel. Needs the Kafka connector of Spark on the class path."""
    (json_payload(df, **payload).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
