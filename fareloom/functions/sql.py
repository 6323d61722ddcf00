"""The payment names for SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .values import PAYMENT_NAMES


def register_sql_functions(spark: SparkSession) -> None:
    """Temporary function ``payment_description(code)``, for any type that casts to an integer."""
    names = " ".join(f"WHEN {code} THEN '{name}'" for code, name in PAYMENT_NAMES.items())
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION payment_description(code STRING) RETURNS STRING "
              f"RETURN CASE try_cast(code AS INT) {names} ELSE 'EMPTY' END")
