"""File writers. Results are directories of part files, never one file made by one task."""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import floor_milli
from ..session import discard, file_system, fresh_dir, setting

#: Rows of a landed part at most, and parts per written file from which on parts are dealt to files whole.
PART_ROWS, PARTS_PER_FILE = 1 << 18, 8


def write_parquet(df: DataFrame, path: str, files: int | None = None, codec: str = "snappy",
                  milliseconds: Sequence[str] = ()) -> None:
    """Overwrite ``path``; ``files`` sets the file count, ``milliseconds`` cuts those times.

    A file is written by one task, so with ``files`` rows are landed first, by all tasks, in parts of bounded rows. Each
    file's task then reads its parts as they lie: columns, compressed, about as many bytes as it writes, and no shuffle.
    A few parts only are dealt row by row, so that files stay even.
    """
    if milliseconds:
        df = df.withColumns({c: floor_milli(c) for c in milliseconds})
    if not files:
        df.write.mode("overwrite").option("compression", codec).parquet(path)
        return
    spark, landed = df.sparkSession, fresh_dir(df.sparkSession, "parts")
    df.write.option("maxRecordsPerFile", PART_ROWS).parquet(landed)
    # A union of frames of one partition each would become one partition, not one for each.
    with setting(spark, "spark.sql.unionOutputPartitioning", "false"):
        _in_files(spark, landed, df.schema, files).write.mode("overwrite").option("compression", codec).parquet(path)
    discard(spark, landed)


def _in_files(spark: SparkSession, landed: str, schema: T.StructType, files: int) -> DataFrame:
    """Landed rows in so many partitions of about equal size."""
    system, folder = file_system(spark, landed)
    parts = sorted(((s.getLen(), s.getPath().toString()) for s in system.listStatus(folder)
                    if s.getPath().getName().startswith("part-")), reverse=True)
    read = spark.read.schema(schema)
    if len(parts) < PARTS_PER_FILE * files:
        return read.parquet(landed).repartition(files)
    dealt = [(0, i, []) for i in range(files)]
    for size, part in parts:
        held, i, own = heapq.heappop(dealt)
        heapq.heappush(dealt, (held + size, i, [*own, part]))
    return reduce(DataFrame.union, [read.parquet(*own).coalesce(1) for _, _, own in dealt])


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None,
              codec: str | None = None) -> None:
    writer = (df.select(*columns) if columns else df).write.mode("overwrite").option("header", True)
    (writer.option("compression", codec) if codec else writer).csv(path)


def write_partitioned(df: DataFrame, path: str, part: str, cluster: Sequence[str] = ()) -> None:
    """One folder per value of ``part``, rows inside a file in the order of ``cluster``.

    Rows of a value are brought together by a rebalance, not a plain repartition: adaptive execution
    splits a value that holds much of the data over several tasks and files, and joins small ones.
    """
    df = df.hint("rebalance", part)
    df.sortWithinPartitions(part, *cluster).write.mode("overwrite").partitionBy(part).parquet(path)


def _number(df: DataFrame, column: str) -> Column:
    """A number, date or time as a double."""
    dated = isinstance(df.schema[column].dataType, T.DateType | T.TimestampNTZType)
    return (F.col(column).cast("timestamp") if dated else F.col(column)).cast("double")


def _cuts(df: DataFrame, columns: Sequence[str], bits: int) -> list[list[float]]:
    """Per column the approximate quantiles that cut its values into ``2 ** bits`` parts of about equal size."""
    parts = 1 << bits
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(*[F.percentile_approx(_number(df, c), shares, 20 * parts).alias(f"c{i}")
                     for i, c in enumerate(columns)]).first()
    return [sorted(set(cuts or [])) for cuts in found]


def _part_of(number: Column, cuts: Sequence[float], bits: int) -> Column:
    """The number of cuts at or below a value, by halving; null comes first."""
    if not cuts:
        return F.lit(0)
    listed = F.array(*[F.lit(float(c)) for c in cuts])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.coalesce(F.get(listed, at + step - 1) <= number, F.lit(False)), at + step).otherwise(at))


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 8) -> Column:
    """A number whose bits are, in turn, those of the columns' quantile parts: rows near in all columns are near in it."""
    cuts = _cuts(df, columns, bits)
    out = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        part = _part_of(_number(df, c), cuts[i], bits).cast("long")
        for b in range(bits):
            bit = F.shiftright(part, b).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(columns) + i))
    return out


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], rows_per_file: int = 1_000_000, bits: int = 8) -> None:
    """Parquet files that a filter on any of the columns (numbers, dates, times) can skip.

    Rows are ordered by the interleaved bits of the columns' quantile parts, so every file holds a small box of all of
    them, whereas sorting by one column after the other clusters the first one only. Skewed values do not matter,
    because parts are quantiles: ``2 ** bits - 1`` numbers per column come to the driver. ``df`` is read twice. Columns
    named ``_z`` are not kept. Parquet keeps no bounds of zoned times in Spark's default form (INT96): store plain ones, or
    set ``spark.sql.parquet.outputTimestampType``.
    """
    ordered = df.withColumn("_z", interleaved(df, columns, bits))
    (ordered.repartitionByRange("_z").sortWithinPartitions("_z").drop("_z")
     .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path))
