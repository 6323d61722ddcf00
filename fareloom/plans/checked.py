"""Loads that check their rows in the pass that reads them, and set aside those that fail."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import discard, fresh_dir

REASONS = "reasons"


@dataclass
class LoadReport:
    rows: int
    rejected: int
    failures: dict[str, int] = field(default_factory=dict)


class TooManyBadRows(ValueError):
    def __init__(self, report: LoadReport, allowed: int):
        super().__init__(f"{report.rejected} of {report.rows} rows are bad, {allowed} are allowed: {report.failures}")
        self.report = report


def load_checked(rows: DataFrame, rules: Mapping[str, Column], table_path: str, quarantine_path: str, max_bad: int = 0,
                 expected_rows: int | None = None) -> LoadReport:
    """Append the rows that keep all ``rules`` to a table, and the others, with the names of the rules they break
    (an array ``reasons``), to a quarantine table.

    A rule is a condition that a good row meets; null counts as broken. ``rows`` is read once: the counts are observed
    while the checked rows are landed. With more than ``max_bad`` bad rows, or another number of rows than
    ``expected_rows``, nothing is appended to either table, and the error has the counts.
    """
    if REASONS in rows.columns:
        raise ValueError(f"a column {REASONS} is in the way")
    spark, landed, seen = rows.sparkSession, fresh_dir(rows.sparkSession, "checked"), Observation()
    names = list(rules)
    broken = F.array(*[F.when(~F.coalesce(rules[n], F.lit(False)), F.lit(n)) for n in names]) if names else F.array().cast("array<string>")
    checked = rows.withColumn(REASONS, F.filter(broken, lambda r: r.isNotNull()))
    checked = checked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.size(REASONS) > 0).alias("rejected"),
                              *[F.count_if(F.array_contains(REASONS, n)).alias(f"f{i}") for i, n in enumerate(names)])
    try:
        checked.write.parquet(landed)
        counts = seen.get
        report = LoadReport(counts["rows"], counts["rejected"], {n: counts[f"f{i}"] for i, n in enumerate(names)})
        if report.rejected > max_bad:
            raise TooManyBadRows(report, max_bad)
        if expected_rows is not None and report.rows != expected_rows:
            raise ValueError(f"{report.rows} rows came, {expected_rows} were expected")
        stored = spark.read.schema(checked.schema).parquet(landed)
        stored.where(F.size(REASONS) == 0).drop(REASONS).write.mode("append").parquet(table_path)
        stored.where(F.size(REASONS) > 0).write.mode("append").parquet(quarantine_path)
    finally:
        discard(spark, landed)
    return report
