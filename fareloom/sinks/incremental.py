"""Aggregates over a growing folder of Parquet files that are refreshed from the new files alone.

For every file and group the *partial state* of each measure is stored: counts, sums, minima and maxima, which can be
merged in any order. A refresh lists the files, reads those it has no state of and appends theirs; a reading merges
the states of the files that are there now. A file that was replaced counts as a new one, one that is gone as gone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import file_system

FILE = "source_file"
#: Per kind of measure: its partial states, how they are merged, and the value.
_STATES = {
    "count": {"n": (F.count, F.sum)},
    "sum": {"s": (F.sum, F.sum)},
    "min": {"a": (F.min, F.min)},
    "max": {"b": (F.max, F.max)},
    "avg": {"s": (F.sum, F.sum), "n": (F.count, F.sum)},
}


class IncrementalAggregate:
    def __init__(self, root: str, source: str, schema: T.StructType, keys: Sequence[str],
                 measures: Mapping[str, tuple[str, str | Column]]):
        """``measures``: per result column its kind (``count``, ``sum``, ``min``, ``max``, ``avg``) and what it measures;
        ``F.lit(1)`` counts rows. ``source``: a folder of Parquet files, ``root``: where the states go."""
        unknown = {kind for kind, _ in measures.values()} - _STATES.keys()
        if unknown:
            raise ValueError(f"no partial state for {', '.join(sorted(unknown))}")
        self.root, self.source, self.schema, self.keys, self.measures = root, source, schema, list(keys), dict(measures)

    @staticmethod
    def _identity() -> Column:
        """A file by name, size and time of its last change."""
        return F.concat_ws("|", "_metadata.file_path", "_metadata.file_size", F.col("_metadata.file_modification_time").cast("string"))

    def _files(self, spark: SparkSession) -> DataFrame:
        """The files of the source, without reading them."""
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(self.source)
        return listed.select("path", self._identity().alias(FILE))

    def _states(self, spark: SparkSession) -> DataFrame | None:
        files, folder = file_system(spark, self.root)
        if not files.exists(folder) or not any(s.getPath().getName().endswith(".parquet") for s in files.listStatus(folder)):
            return None
        return spark.read.parquet(self.root)

    def new_files(self, spark: SparkSession) -> list[str]:
        """Paths of the files that no refresh has read. The driver lists files anyway; their rows do not come here."""
        listed, states = self._files(spark), self._states(spark)
        if states is not None:
            listed = listed.join(states.select(FILE).distinct(), FILE, "left_anti")
        return sorted(r.path for r in listed.collect())

    def new_rows(self, spark: SparkSession, paths: Sequence[str]) -> DataFrame:
        return spark.read.schema(self.schema).parquet(*paths)

    def refresh(self, spark: SparkSession) -> int:
        """Read the files that are new and keep their states; returns how many there were.

        All states of a file are written by one task into one file, so an interrupted refresh leaves files with all of
        their states or none, and the next one goes on with the rest.
        """
        paths = self.new_files(spark)
        if not paths:
            return 0
        partial = [update(measured).alias(f"{name}__{state}") for name, (kind, measured) in self.measures.items()
                   for state, (update, _) in _STATES[kind].items()]
        states = (self.new_rows(spark, paths).groupBy(self._identity().alias(FILE), *self.keys)
                  .agg(F.lit(True).alias("has_rows"), *partial))
        # A file without rows is remembered by a row without the mark, or every refresh would read it again.
        seen = self._files(spark).where(F.col("path").isin(paths)).select(FILE)
        seen.join(states, FILE, "left").repartition(FILE).write.mode("append").parquet(self.root)
        return len(paths)

    def read(self, spark: SparkSession) -> DataFrame:
        """One row per group, from the states of the files that are in the source now."""
        states = self._states(spark)
        if states is None:
            raise ValueError(f"{self.root} was never refreshed")
        states = states.where("has_rows").join(self._files(spark).select(FILE), FILE, "left_semi")
        merged = states.groupBy(*self.keys).agg(*[
            merge(f"{name}__{state}").alias(f"{name}__{state}") for name, (kind, _) in self.measures.items()
            for state, (_, merge) in _STATES[kind].items()])
        out = {}
        for name, (kind, _) in self.measures.items():
            parts = [F.col(f"{name}__{state}") for state in _STATES[kind]]
            out[name] = parts[0] / parts[1] if kind == "avg" else parts[0]
        return merged.select(*self.keys, *[value.alias(name) for name, value in out.items()])
