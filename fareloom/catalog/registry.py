"""Collects queries by key, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import use_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and zoned times as wall clock, as the checking engine shows them."""
    changed = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            changed[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            changed[f.name] = F.col(f.name).cast("timestamp_ntz")
    return df.withColumns(changed) if changed else df


def query(key: str, sql: str | None = None):
    def add(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(use_utc(spark), sf_dir))
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return build
    return add
