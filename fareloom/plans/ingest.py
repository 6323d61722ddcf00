"""Monthly ingest: files to a staging frame, row hash, insert-only merge into a table by pickup month."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import row_hash
from ..operators.joins import unmatched
from ..schemas import TRIP_CSV
from ..session import discard, file_system, fresh_dir, setting
from ..sources.files import scan_months

PART = "pickup_month"
#: Folders that a task of monthly files writes side by side; rows of further ones are sorted first.
MONTHS_PER_TASK = 16
#: Rows of a bucket in the first load of a bucketed table.
BUCKET_ROWS = 1 << 20
_PICKUP = {"yellow": "tpep_pickup_datetime", "green": "lpep_pickup_datetime"}
_DROPOFF = {"yellow": "tpep_dropoff_datetime", "green": "lpep_dropoff_datetime"}


def with_row_id(df: DataFrame, kind: str, filename: str | None = None) -> DataFrame:
    """Add ``unique_row_id``, the hash of the seven identifying fields, and the file name if given."""
    hashed = row_hash("VendorID", _PICKUP[kind], _DROPOFF[kind], "PULocationID", "DOLocationID",
                      "fare_amount", "trip_distance")
    df = df.withColumn("unique_row_id", hashed)
    return df if filename is None else df.withColumn("filename", F.lit(filename))


def with_month(df: DataFrame, pickup: str) -> DataFrame:
    return df.withColumn(PART, F.date_format(F.col(pickup), "yyyy-MM"))


def packed(key: str) -> Column:
    """A row id in few bytes, equal for equal ids only: a hash in hexadecimal digits as its 16 bytes, another text behind
    17 zero bytes, null as null."""
    text = F.col(key).cast("string")
    return F.when(text.rlike(r"\A[0-9a-f]{32}\z"), F.unhex(text)).otherwise(F.concat(F.lit(bytes(17)), text.cast("binary")))


def in_months(target: DataFrame, staged: DataFrame) -> DataFrame:
    """Target rows that can equal a staged one, both with a ``pickup_month``.

    Rows with equal hashes have equal pickup times, so only the months that occur in the staged rows are
    read from the target. The list of months is bounded by the calendar, not by the data.
    """
    months = [r[0] for r in staged.select(PART).where(F.col(PART).isNotNull()).distinct().collect()]
    return target.where(F.col(PART).isin(months) | F.col(PART).isNull())


def stored(spark: SparkSession, table_path: str, schema) -> DataFrame:
    """The table; its schema is given so that months stay text."""
    return spark.read.schema(schema).parquet(table_path)


def _is_there(spark: SparkSession, path: str) -> bool:
    files, hadoop = file_system(spark, path)
    return files.exists(hadoop)


def _append(staging: DataFrame, table_path: str, *parts: str, monthly: bool = False) -> None:
    """Add rows in their folders. ``monthly``: each task has rows of few months, as a scan of monthly files gives them;
    they are written where they are, without a shuffle or a sort. Other rows are brought together first."""
    parts = parts or (PART,)
    if monthly:
        with setting(staging.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(MONTHS_PER_TASK)):
            staging.write.mode("append").partitionBy(*parts).parquet(table_path)
    else:
        staging.hint("rebalance", *parts).write.mode("append").partitionBy(*parts).parquet(table_path)


def loaded_files(spark: SparkSession, table_path: str) -> list[str]:
    """The names of the files in a table with one folder per file, from the folders alone."""
    files, folder = file_system(spark, table_path)
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    return sorted(unquote(n.removeprefix("filename=")) for n in names if n.startswith("filename="))


def store(spark: SparkSession, table_path: str, staging: DataFrame,
          key: str = "unique_row_id", monthly: bool = False) -> None:
    """Merge staged rows into the table, made by the first load, with one folder per pickup month.

    Row ids and months alone are landed and meet the ids of the table; whole rows are read again for those ids that it
    lacks, if any, so ``staging`` must give the same rows each time, as a scan of files does. The landed folders go when
    the rows are stored. A first load, or one into months the table lacks, has nothing to meet. ``monthly`` as in
    ``_append``.
    """
    if not _is_there(spark, table_path):
        _append(staging, table_path, monthly=monthly)
        return
    landed, lacking = fresh_dir(spark, "staging"), fresh_dir(spark, "lacking")
    staging.select(packed(key).alias("_id"), PART).write.parquet(landed)
    ids = spark.read.parquet(landed)
    held = in_months(stored(spark, table_path, staging.schema), ids).select(packed(key).alias("_id"))
    if held.isEmpty():
        _append(staging, table_path, monthly=monthly)
    else:
        unmatched(ids.select("_id"), held, "_id").write.parquet(lacking)
        new = spark.read.schema("_id binary").parquet(lacking)
        if not new.isEmpty():
            rows = staging.withColumn("_id", packed(key))
            found = rows.join(new, "_id", "left_semi").select(staging.columns)
            _append(found.union(staging.where(F.col(key).isNull())), table_path)
        discard(spark, lacking)
    discard(spark, landed)


def ingest_months(spark: SparkSession, root: str, kind: str, months: Sequence[str],
                  table_path: str, template: str = "{kind}_tripdata_{month}.csv.gz",
                  gaps: bool = False, bad_rows: str = "fail") -> None:
    """Load the files of one month, or of a range for a backfill. Loading them again adds nothing.

    Yellow and green rows are told apart by their hash. For-hire rows have no identifying fields: they are stored in
    one folder per file, a file whose folder is there is left out, and every other one is appended whole. No stored row
    is read for that.
    """
    rows = scan_months(spark, root, kind, months, TRIP_CSV[kind], template, gaps=gaps, bad_rows=bad_rows)
    if kind in _PICKUP:
        store(spark, table_path, with_month(with_row_id(rows, kind), _PICKUP[kind]), monthly=True)
        return
    rows = with_month(rows, "pickup_datetime")
    known = loaded_files(spark, table_path)
    _append(rows.where(~F.col("filename").isin(known)) if known else rows, table_path, "filename", PART, monthly=True)


def store_bucketed(name: str, staging: DataFrame, path: str, key: str = "unique_row_id", buckets: int = 64) -> DataFrame:
    """Merge staged rows into a catalog table that is bucketed and sorted by the row id; the first load makes it.

    The staged rows are dealt to the buckets once, for the join and for the files alike, one file per bucket and load.
    The target is read bucket by bucket and never shuffled, however large it is. A new table has ``buckets`` buckets, or
    as many times 2, 4, 8 and so on as keep those of its first load, which is counted for that, at ``BUCKET_ROWS`` rows
    on the average. A task sorts one bucket and the rows dealt to it; beyond its memory Spark sorts on disk.
    """
    spark = staging.sparkSession
    there = spark.catalog.tableExists(name)
    if there:
        lines = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").collect()
        if not lines:
            raise ValueError(f"{name} is not bucketed")
        buckets = int(lines[0]["data_type"])
        staging = staging.select(*spark.table(name).columns)
    else:
        rows = staging.count()
        while rows > buckets * BUCKET_ROWS:
            buckets *= 2
    new = new_for_buckets(spark.table(name), staging, key, buckets) if there else staging.repartition(buckets, key)
    (new.write.mode("append").bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(name))
    return spark.table(name)


def new_for_buckets(target: DataFrame, staging: DataFrame, key: str, buckets: int) -> DataFrame:
    """Staged rows that a table bucketed by ``key`` lacks, dealt as its buckets are. Rows without a key are all new."""
    dealt = staging.repartition(buckets, key)
    return dealt.join(target.select(F.col(key).alias("_key")).hint("merge"), F.col(key) == F.col("_key"), "left_anti")
