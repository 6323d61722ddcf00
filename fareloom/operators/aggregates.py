"""Grouped and global aggregates, and the ordered picks made from them.

All of them are built-in aggregates with a map-side part, so a hot group reaches the final stage as one
partial row per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Keys = Iterable[str] | Mapping[str, Column]


def _columns(keys: Keys) -> list[Column]:
    if isinstance(keys, Mapping):
        return [expr.alias(name) for name, expr in keys.items()]
    return [F.col(name) for name in keys]


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def count_by(df: DataFrame, keys: Keys, column: str | None = None, name: str = "count"
             ) -> DataFrame:
    """Rows per group, or the non-null values of ``column`` per group."""
    return df.groupBy(*_columns(keys)).agg(F.count(column or "*").alias(name))


def count_distinct(df: DataFrame, column: str, name: str = "distinct_count",
                   approx: bool = False) -> DataFrame:
    counter = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(counter(F.col(column)).alias(name))


def distinct(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    return (df if columns is None else df.select(*columns)).distinct()


def sum_by(df: DataFrame, keys: Keys, column: str, name: str | None = None) -> DataFrame:
    return df.groupBy(*_columns(keys)).agg(F.sum(column).alias(name or column))


def avg_of(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.agg(F.avg(value).alias(name))


def max_of(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.agg(F.max(value).alias(name))


def max_by_key(df: DataFrame, keys: Keys, column: str, name: str) -> DataFrame:
    return df.groupBy(*_columns(keys)).agg(F.max(column).alias(name))


def top_k(df: DataFrame, column: str, k: int, tie_break: Iterable[str]) -> DataFrame:
    """The ``k`` rows with the largest ``column``; ties in the order of ``tie_break``."""
    return df.orderBy(F.desc(column), *tie_break).limit(k)


def bottom_k(df: DataFrame, column: str, k: int, tie_break: Iterable[str]) -> DataFrame:
    return df.orderBy(F.asc(column), *tie_break).limit(k)


def top_by_max(df: DataFrame, keys: Keys, column: str, name: str, k: int = 1) -> DataFrame:
    """The groups with the largest maximum."""
    ties = list(keys)
    return top_k(max_by_key(df, keys, column, name), name, k, ties)


def sum_having(df: DataFrame, keys: Keys, column: str, floor, name: str) -> DataFrame:
    """Group sums above ``floor``."""
    return sum_by(df, keys, column, name).where(F.col(name) > F.lit(floor))


def union_tagged(parts: Mapping[str, DataFrame], tag: str = "service_type") -> DataFrame:
    """All parts under each other, matched by column name, each marked with its key."""
    return union_all([df.withColumn(tag, F.lit(name)) for name, df in parts.items()])


def union_all(parts: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    first, *rest = parts
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=allow_missing)
    return first


#: log2 of the registers of a distinct sketch, and the bound its estimates keep in 997 of 1,000 cases.
LG_K = 12
SKETCH_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)


def distinct_sketches(df: DataFrame, day: str, value: str, lg_k: int = LG_K) -> DataFrame:
    """One row per day with a mergeable sketch of the distinct values: store it, and no range scans the days again.

    The sketch has at most ``2 ** lg_k`` bytes, however many values a day has, and is made with a map side.
    """
    return df.where(F.col(day).isNotNull()).groupBy(day).agg(F.hll_sketch_agg(value, lg_k).alias("sketch"))


def distinct_between(sketches: DataFrame, day: str, first: str, last: str) -> DataFrame:
    """The estimated number of distinct values over the days ``first`` to ``last``, both included: column ``distinct_values``."""
    days = sketches.where(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return days.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).cast("long").alias("distinct_values"))
