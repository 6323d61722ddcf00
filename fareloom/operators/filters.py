"""Row filters. Time bounds are plain literals on the raw column, so they reach the file scan."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Day = dt.date | str


def as_day(value: Day) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def project(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*columns)


def where_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def where_ne(df: DataFrame, column: str, value) -> DataFrame:
    """Rows that differ from ``value``. Null is not different: those rows leave as well."""
    return df.where(F.col(column) != F.lit(value))


def where_in(df: DataFrame, column: str, values: Iterable, lower: bool = False) -> DataFrame:
    tested = F.lower(F.col(column)) if lower else F.col(column)
    return df.where(tested.isin(*values))


def where_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def where_positive(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    for column in columns:
        df = df.where(F.col(column) > 0)
    return df


def between_half_open(df: DataFrame, columns: str | Iterable[str], low: Day, high: Day
                      ) -> DataFrame:
    """``low <= column < high`` for every given column."""
    for column in [columns] if isinstance(columns, str) else columns:
        df = df.where((F.col(column) >= F.lit(as_day(low))) & (F.col(column) < F.lit(as_day(high))))
    return df


def between_days(df: DataFrame, ts: str, low: Day, high: Day, part: str | None = None
                 ) -> DataFrame:
    """Whole days from ``low`` to ``high``, both included.

    ``part`` names a date partition column made from ``ts``; the same bounds on it let the scan skip
    partitions, which a bound on ``ts`` alone does not.
    """
    first, last = as_day(low), as_day(high)
    df = between_half_open(df, ts, first, last + dt.timedelta(days=1))
    return df if part is None else df.where(F.col(part).between(F.lit(first), F.lit(last)))


def between_literal(df: DataFrame, ts: str, low: Day, high: Day, part: str | None = None
                    ) -> DataFrame:
    """``ts BETWEEN low AND high`` where a date means its midnight, so the last day is cut there."""
    first, last = as_day(low), as_day(high)
    df = df.where(F.col(ts).between(F.lit(first), F.lit(last)))
    return df if part is None else df.where(F.col(part).between(F.lit(first), F.lit(last)))


def on_day(df: DataFrame, ts: str, day: Day) -> DataFrame:
    return between_days(df, ts, day, day)


def days_back(argument: int | None = None, variable: str = "DAYS_BACK", default: int = 30) -> int:
    """The argument, else the environment variable, else the default."""
    return int(argument if argument is not None else os.environ.get(variable, default))


def last_days(df: DataFrame, ts: str, as_of: Day, days: int | None = None) -> DataFrame:
    """Rows from ``days`` days before ``as_of`` on."""
    first = as_day(as_of) - dt.timedelta(days=days_back(days))
    return df.where(F.col(ts) >= F.lit(first))


def cap(df: DataFrame, rows: int | None = None) -> DataFrame:
    """All rows, or an arbitrary ``rows`` of them for a test run."""
    return df if rows is None else df.limit(rows)


def first_rows(df: DataFrame, rows: int, order_by: list[str | Column]) -> DataFrame:
    return df.orderBy(*order_by).limit(rows)


def with_constants(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def fill(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(v)) for name, v in values.items()})


def flatten(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Nested fields by path, under new names."""
    return df.select(*[F.col(path).alias(name) for path, name in paths.items()])
