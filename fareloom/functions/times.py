"""Date and time functions. A timestamp without zone is read as UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def date_parts(ts: ColumnOrName) -> list[Column]:
    """Columns ``year``, ``month`` and ``quarter``."""
    ts = _col(ts)
    return [F.year(ts).alias("year"), F.month(ts).alias("month"), F.quarter(ts).alias("quarter")]


def year_quarter(ts: ColumnOrName) -> Column:
    """A label such as ``2019/Q1``."""
    ts = _col(ts)
    return F.concat(F.year(ts).cast("string"), F.lit("/Q"), F.quarter(ts).cast("string"))


def day(ts: ColumnOrName) -> Column:
    return F.to_date(_col(ts))


def month_start(ts: ColumnOrName) -> Column:
    return F.trunc(F.to_date(_col(ts)), "month").cast("timestamp_ntz")


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Seconds from ``start`` to ``end``: positive when ``end`` is later."""
    return F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))


def boundary_minutes(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Minute boundaries crossed, so 00:00:59 to 00:01:01 counts as 1."""
    def minute(ts: ColumnOrName) -> Column:
        return F.floor(F.unix_timestamp(_col(ts)) / 60)
    return minute(end) - minute(start)


def hours_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Elapsed hours with their fraction."""
    return seconds_between(start, end) / F.lit(3600.0)


def days_before(as_of: dt.date | str, days: int) -> Column:
    return F.date_sub(F.lit(as_of).cast("date"), days)


def _or_fail(text: Column, parsed: Column, bad: str) -> Column:
    if bad == "null":
        return parsed
    if bad != "fail":
        raise ValueError(f"unknown way to treat bad text: {bad!r}")
    message = F.concat(F.lit("not a time: "), text)
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(message).cast("timestamp_ntz")).otherwise(parsed)


def parse_ts(text: ColumnOrName, fmt: str | None = None, bad: str = "fail") -> Column:
    """Text to a wall-clock time. Text that does not parse stops the job, or is null with ``bad="null"``."""
    text = _col(text)
    parsed = text.try_cast("timestamp_ntz") if fmt is None else F.try_to_timestamp(
        text, F.lit(fmt)).cast("timestamp_ntz")
    return _or_fail(text, parsed, bad)


def floor_second(ts: ColumnOrName) -> Column:
    return F.date_trunc("second", _col(ts)).cast("timestamp_ntz")


def floor_milli(ts: ColumnOrName) -> Column:
    return F.date_trunc("millisecond", _col(ts)).cast("timestamp_ntz")


def naive_utc(text: ColumnOrName, bad: str = "fail") -> Column:
    """A zoned time text as its UTC wall clock, cut to milliseconds; ``bad`` as in ``parse_ts``."""
    text = _col(text)
    return _or_fail(text, floor_milli(text.try_cast("timestamp")), bad)
