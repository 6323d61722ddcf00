"""Where datasets live: a name resolves to a path or to a table in the namespace of its layer."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


class Sources:
    """Names of datasets for one namespace.

    The namespace is the argument, else the environment variable ``variable``, else ``default``.
    """

    def __init__(self, spark: SparkSession, schema: str | None = None,
                 paths: Mapping[str, str] | None = None, variable: str = "FARELOOM_SCHEMA",
                 default: str = "trips",
                 core_variable: str = "FARELOOM_TARGET_SCHEMA",
                 staging_variable: str = "FARELOOM_STAGING_SCHEMA"):
        self.spark = spark
        self.schema = schema or os.environ.get(variable, default)
        self.paths = dict(paths or {})
        self.core_variable, self.staging_variable = core_variable, staging_variable

    def table(self, name: str) -> DataFrame:
        if name in self.paths:
            return self.spark.read.parquet(self.paths[name])
        return self.spark.table(self.full_name(name))

    def full_name(self, name: str) -> str:
        return f"{self.schema}.{name}"

    def schema_for(self, layer: str) -> str:
        """Core models go to the target schema, which must be set; others to the staging schema, which
        falls back to the target."""
        target = os.environ.get(self.core_variable)
        chosen = target if layer == "core" else os.environ.get(self.staging_variable, target)
        if not chosen:
            raise KeyError(self.core_variable)
        return chosen
