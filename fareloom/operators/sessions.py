"""Session and tumbling counts over finished tables. The streaming twins are in ``fareloom.streaming``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import top_k


def session_counts(df: DataFrame, keys: Sequence[str], ts: str, gap_seconds: int = 300,
                   name: str = "num_trips", column: str = "*") -> DataFrame:
    """Sessions per key: rows no more than the gap apart belong together; the end is last + gap.

    ``column`` counts its non-null values instead of rows.

    Rows of one key and one stretch of gap length always share a session, so they are first counted
    per stretch. That spreads a hot key over the time line and leaves at most one row per stretch,
    however many rows it had; only those are then put in order.
    """
    gap = gap_seconds * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    counted = F.lit(1) if column == "*" else F.when(F.col(column).isNotNull(), 1)
    stretches = (
        df.where(F.col(ts).isNotNull())
        .select(*keys, micros.alias("_t"), counted.alias("_counted"))
        .groupBy(*keys, F.floor(F.col("_t") / F.lit(gap)).alias("_stretch"))
        .agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"), F.count("_counted").alias("_n"))
    )
    line = Window.partitionBy(*keys).orderBy("_stretch")
    starts = F.coalesce((F.col("_first") - F.lag("_last").over(line) > gap).cast("int"), F.lit(1))
    return (
        stretches.withColumn("_starts", starts)
        .withColumn("_session", F.sum("_starts").over(line))
        .groupBy(*keys, "_session")
        .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias(name))
        .select(*keys,
                F.timestamp_micros("_first").cast("timestamp_ntz").alias("session_start"),
                F.timestamp_micros(F.col("_last") + gap).cast("timestamp_ntz").alias("session_end"),
                name)
    )


def longest_streaks(sessions: DataFrame, k: int, tie_break: Sequence[str],
                    name: str = "num_trips") -> DataFrame:
    return top_k(sessions, name, k, tie_break)
