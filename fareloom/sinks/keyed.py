"""A table with one row per key that takes merges by rewriting only the buckets they touch.

A bucket is a hash of the key and a partition of a Parquet table. A merge joins the source with the buckets it touches
and writes these with Spark's dynamic partition overwrite; all other buckets keep their files. The number of buckets
is the name of the folder above them, so a table can grow: ``resize`` writes it anew with more buckets.

One writer at a time: a second one is refused before it reads anything. A reader that began before a merge must read
again, and so must one that meets the moment in which touched buckets are exchanged; where readers may not notice
merges, put the table into a table format with snapshots.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merges import upsert
from ..session import discard, file_system, fresh_dir, fresh_dir_in

BUCKET = "bucket"
#: The batches that made a row: the last number of each run. A column of the files, not of the table.
MERGED = "merged_batches"


class KeyedTable:
    def __init__(self, root: str, schema: T.StructType, key: Sequence[str], buckets: int = 64):
        """``buckets`` counts for a table that is yet to be made; one that is there has its own."""
        self.root, self.schema, self.key, self.buckets = root.rstrip("/"), schema, list(key), buckets
        self._files = T.StructType([*schema.fields, T.StructField(MERGED, T.MapType(T.StringType(), T.LongType()))])

    def _sizes(self, spark: SparkSession) -> list[int]:
        """The numbers of buckets of all layouts: one, or two while ``resize`` exchanges them."""
        files, folder = file_system(spark, self.root)
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        return sorted(int(n[2:]) for n in names if re.fullmatch(r"n=\d+", n))

    def _path(self, size: int) -> str:
        return f"{self.root}/n={size}"

    def _stored(self, spark: SparkSession, size: int | None) -> DataFrame:
        if size is None:
            return spark.createDataFrame([], self._files).withColumn(BUCKET, F.lit(0))
        schema = T.StructType([*self._files.fields, T.StructField(BUCKET, T.IntegerType())])
        return spark.read.schema(schema).parquet(self._path(size))

    def _bucket(self, size: int):
        return F.pmod(F.xxhash64(*self.key), F.lit(size)).cast("int")

    @contextmanager
    def _writing(self, spark: SparkSession) -> Iterator[None]:
        """Holds the table for one writer. The file is made by one writer only, where the file system says so."""
        files, mark = file_system(spark, f"{self.root}/_writer")
        try:
            files.create(mark, False).close()
        except Py4JJavaError as e:
            if not files.exists(mark):
                raise
            raise RuntimeError(f"another writer has {self.root}; if it died, call unlock") from e
        try:
            yield
        finally:
            files.delete(mark, False)

    def unlock(self, spark: SparkSession) -> None:
        """Take the table from a writer that died. Its merge, if half done, is to be repeated."""
        files, mark = file_system(spark, f"{self.root}/_writer")
        files.delete(mark, False)

    def read(self, spark: SparkSession) -> DataFrame:
        sizes = self._sizes(spark)
        return self._stored(spark, sizes[-1] if sizes else None).select(*self.schema.names)

    def merge(self, source: DataFrame, set_columns: Sequence[str], mode: str = "replace",
              run: str | None = None, batch: int | None = None) -> None:
        """Update matched rows and insert new ones; ``mode`` as in ``upsert``. A key that occurs twice in the
        source, or a null in it, is an error, and nothing changes.

        With the name of a ``run`` and the number of a ``batch`` every row remembers what it was made from, and a row
        that has this batch or a later one of the run stays as it is: adding is safe to repeat, also after a merge
        that was broken off between two buckets.
        """
        spark = source.sparkSession
        with self._writing(spark):
            sizes = self._sizes(spark)
            size = sizes[-1] if sizes else self.buckets
            landed = fresh_dir(spark, "source")
            columns = [F.col(f.name).cast(f.dataType) for f in self.schema.fields]
            source.select(*columns, self._bucket(size).alias(BUCKET)).write.parquet(landed)
            source = spark.read.schema(T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(landed)
            # Keys are counted with a map side; at most one number per bucket comes to the driver.
            empty = F.lit(False)
            for k in self.key:
                empty = empty | F.col(k).isNull()
            seen = (source.groupBy(*self.key, BUCKET).agg(F.count(F.lit(1)).alias("n"))
                    .agg(F.max("n").alias("most"), F.bool_or(empty).alias("empty"), F.collect_set(BUCKET).alias("touched")).first())
            try:
                if seen.empty:
                    raise ValueError("a source row without a key")
                if (seen.most or 0) > 1:
                    raise ValueError("more than one source row for a key")
                if seen.touched:
                    self._rewrite(spark, source, size, sorted(seen.touched), bool(sizes), list(set_columns), mode, run, batch)
            finally:
                discard(spark, landed)

    def _rewrite(self, spark: SparkSession, source: DataFrame, size: int, touched: list[int], there: bool,
                 set_columns: list[str], mode: str, run: str | None, batch: int | None) -> None:
        merged = source.drop(BUCKET)
        if run is None or batch is None:
            merged = merged.withColumn(MERGED, F.lit(None).cast("map<string,bigint>"))
        else:
            merged = merged.withColumn(MERGED, F.create_map(F.lit(run), F.lit(batch).cast("long")))
        out = merged.select(*self._files.names)
        if there:
            out = self._joined(self._stored(spark, size).where(F.col(BUCKET).isin(touched)), merged, set_columns, mode, run, batch)
        (out.withColumn(BUCKET, self._bucket(size)).hint("rebalance", BUCKET).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self._path(size)))

    def _joined(self, old: DataFrame, merged: DataFrame, set_columns: list[str], mode: str, run: str | None, batch: int | None) -> DataFrame:
        if run is not None and batch is not None:
            known = F.coalesce(F.try_element_at(F.col(MERGED), F.lit(run)), F.lit(-1)) >= batch
            done = old.where(known).select(*self.key)
            # Rows that this batch has made before meet no source row again.
            merged = merged.join(done, self.key, "left_anti")
        return upsert(old.drop(BUCKET), merged, self.key, set_columns, mode, unique=True, joined_maps=[MERGED])

    def resize(self, spark: SparkSession, buckets: int) -> None:
        """Write the table anew with more buckets, when they have become too large. The new layout is written aside
        and gets its name when it is finished; readers take it from then on."""
        with self._writing(spark):
            sizes = self._sizes(spark)
            if sizes and buckets <= sizes[-1]:
                raise ValueError(f"{self.root} has {sizes[-1]} buckets already")
            self.buckets = buckets
            if sizes:
                rows = self._stored(spark, sizes[-1]).withColumn(BUCKET, self._bucket(buckets))
                aside = fresh_dir_in(self.root, "_resized")
                rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(aside)
                files, done = file_system(spark, aside)
                if not files.rename(done, file_system(spark, self._path(buckets))[1]):
                    raise RuntimeError(f"{aside} cannot be renamed")
                for size in sizes:
                    discard(spark, self._path(size))
