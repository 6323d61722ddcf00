"""Data checks. Each returns one row (or one per column): check, column, severity, failures."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import union_all
from .joins import orphans

WARN, ERROR = "warn", "error"


class CheckFailed(Exception):
    pass


def _bind(df: DataFrame, *columns: str) -> None:
    have = {c.lower() for c in df.columns}
    absent = [c for c in columns if c.lower() not in have]
    if absent:
        raise ValueError(f"no such column to check: {', '.join(absent)}")


def _result(df: DataFrame, check: str, column: str, severity: str, failures: Column) -> DataFrame:
    return df.agg(F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit(check).alias("check"), F.lit(column).alias("column"),
        F.lit(severity).alias("severity"), "failures")


def check_unique(df: DataFrame, column: str, severity: str = ERROR) -> DataFrame:
    """Failures are the values that occur more than once."""
    _bind(df, column)
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    return _result(counts, "unique", column, severity, F.count_if(F.col("_n") > 1))


def check_not_null(df: DataFrame, columns: Sequence[str], severity: str = ERROR) -> DataFrame:
    """Null counts of all columns in one pass."""
    _bind(df, *columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    lines = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("failures"))
                      for c in columns])
    return counted.select(F.explode(lines).alias("r")).select(
        F.lit("not_null").alias("check"), "r.column", F.lit(severity).alias("severity"),
        F.col("r.failures").cast("bigint").alias("failures"))


def check_columns(df: DataFrame, not_null: Sequence[str] = (), accepted: dict[str, Sequence] | None = None,
                  severity: str = ERROR) -> DataFrame:
    """Null counts and unaccepted values of all columns in one pass over the data."""
    accepted = accepted or {}
    _bind(df, *not_null, *accepted)
    counts = [("not_null", c, F.count_if(F.col(c).isNull())) for c in not_null]
    counts += [("accepted_values", c, F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*values)))
               for c, values in accepted.items()]
    counted = df.agg(*[n.cast("bigint").alias(f"_{i}") for i, (_, _, n) in enumerate(counts)])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(check).alias("check"), F.lit(c).alias("column"), F.lit(severity).alias("severity"),
                 F.col(f"_{i}").alias("failures")) for i, (check, c, _) in enumerate(counts)])))


def unaccepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """The values outside the accepted list with their row counts."""
    _bind(df, column)
    return (df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
            .groupBy(column).agg(F.count("*").alias("rows")))


def check_accepted(df: DataFrame, column: str, values: Sequence, severity: str = ERROR
                   ) -> DataFrame:
    """Failures are the rows whose value is neither null nor accepted."""
    return _result(unaccepted(df, column, values), "accepted_values", column, severity,
                   F.sum("rows"))


def check_relationships(df: DataFrame, fk: str, parent: DataFrame, pk: str, severity: str = ERROR
                        ) -> DataFrame:
    """Failures are the rows whose key the parent does not have."""
    _bind(df, fk)
    _bind(parent, pk)
    return _result(orphans(df, fk, parent, pk), "relationships", fk, severity, F.sum("rows"))


def check_row_total(df: DataFrame, rows: int, severity: str = ERROR) -> DataFrame:
    """Failures are the rows missing from, or beyond, the expected total."""
    return _result(df, "row_total", "*", severity, F.abs(F.count("*") - F.lit(rows)))


def check_freshness(df: DataFrame, ts: str, max_age_hours: float, as_of: dt.datetime,
                    severity: str = ERROR) -> DataFrame:
    """One failure when the newest row is older than allowed at ``as_of``, or there is none."""
    _bind(df, ts)
    oldest = (as_of - dt.timedelta(hours=max_age_hours)).isoformat(sep=" ")
    stale = F.coalesce(F.max(ts) < F.lit(oldest).cast("timestamp_ntz"), F.lit(True))
    return _result(df, "freshness", ts, severity, stale.cast("int"))


def quality_report(checks: Sequence[DataFrame]) -> DataFrame:
    """All check rows, with a status: pass, warn or error."""
    status = F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity"))
    return union_all(checks).withColumn("status", status)


def enforce(report: DataFrame) -> DataFrame:
    """Raise if a check of level error failed; warnings pass. The checks run once: the rows returned, one per
    check, are those that were looked at."""
    rows = report.collect()
    failed = [r for r in rows if r["status"] == "error"]
    if failed:
        raise CheckFailed("; ".join(f"{r['check']}({r['column']}): {r['failures']}" for r in failed))
    return report.sparkSession.createDataFrame(rows, report.schema)
