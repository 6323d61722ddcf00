"""Ordered picks per group: first row, previous year, n-th place, best and worst."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pct_change


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
                ) -> DataFrame:
    """The first row of every key.

    ``order_by`` should be a total order, so that the kept row is the same in every run. Nulls come
    last. Spark cuts each key to one row per task before the shuffle, so many copies of one key do not
    meet in one task.
    """
    if not order_by:
        raise ValueError("an order is needed to say which row is the first")
    order = [F.asc_nulls_last(c) if isinstance(c, str) else c for c in order_by]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def yoy(df: DataFrame, keys: Sequence[str], year: str, value: str, strict_year: bool = False
        ) -> DataFrame:
    """The value of the previous year within ``keys`` and the growth in percent.

    The previous year is the last one present. ``strict_year`` leaves both columns null unless that is
    really the year before.
    """
    window = Window.partitionBy(*keys).orderBy(year)
    previous = F.lag(value).over(window)
    if strict_year:
        previous = F.when(F.lag(year).over(window) == F.col(year) - 1, previous)
    return (df.withColumn(f"prev_year_{value}", previous)
            .withColumn("yoy_percentage_change", pct_change(value, f"prev_year_{value}")))


def nth_by(df: DataFrame, keys: Sequence[str], column: str, n: int, desc: bool = True
           ) -> DataFrame:
    """The rows holding the n-th largest (or smallest) distinct value of each group."""
    order = F.desc(column) if desc else F.asc(column)
    window = Window.partitionBy(*keys).orderBy(order)
    return (df.withColumn("_place", F.dense_rank().over(window))
            .where(F.col("_place") == n).drop("_place"))


def best_worst(df: DataFrame, keys: Sequence[str], label: str, value: str) -> DataFrame:
    """The label with the largest and with the smallest value per group; ties by label."""
    up = F.struct(F.col(value).alias("value"), F.col(label).alias("label"))
    # The label is wanted in rising order in both cases, so the best is the least negated value.
    down = F.struct((-F.col(value)).alias("value"), F.col(label).alias("label"))
    present = df.where(F.col(value).isNotNull())
    return present.groupBy(*keys).agg(F.min(down).alias("_best"), F.min(up).alias("_worst")).select(
        *keys,
        F.col("_best.label").alias(f"best_{label}"), (-F.col("_best.value")).alias(f"best_{value}"),
        F.col("_worst.label").alias(f"worst_{label}"), F.col("_worst.value").alias(f"worst_{value}"))
