"""Event streams: a topic of JSON messages, or a folder that files arrive in."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


@dataclass(frozen=True)
class TopicConfig:
    servers: str
    topic: str
    start: str = "earliest"
    max_per_batch: int | None = None
    options: dict[str, str] = field(default_factory=dict)


def decode(messages: DataFrame, schema: T.StructType = schemas.TRIP_MESSAGE) -> DataFrame:
    """The fields of JSON messages held in a binary or text column ``value``."""
    return messages.select(
        F.from_json(F.col("value").cast("string"), schema).alias("m")).select("m.*")


def stream_events(spark: SparkSession, config: TopicConfig,
                  schema: T.StructType = schemas.TRIP_MESSAGE) -> DataFrame:
    """The messages of a topic. Needs the Kafka connector of Spark on the class path."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", config.servers)
              .option("subscribe", config.topic)
              .option("startingOffsets", config.start))
    if config.max_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", config.max_per_batch)
    return decode(reader.options(**config.options).load(), schema)


def stream_files(spark: SparkSession, path: str, schema: T.StructType,
                 max_files: int | None = None, max_bytes: str | None = None) -> DataFrame:
    """Parquet files arriving in a folder, or matching a pattern. The limits bound one micro-batch of a long backlog."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def stream_event_lines(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """JSON-lines files arriving in a folder; a broken line stops the stream with its file."""
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).json(path)
