"""File scans. Schemas are declared; inference costs a pass over the data and is only done on request."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..session import file_system

CORRUPT = "_corrupt_record"
_EMPTY_PAGE_BYTES = 64


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
             infer: bool = False, bad_rows: str = "fail") -> DataFrame:
    """CSV with a header line, with a declared schema or types inferred from the data.

    With a schema the names of each file's header must be the declared ones in their order (their case does not
    matter), and ``bad_rows`` says what becomes of lines that do not fit: ``"fail"`` stops at the first one,
    ``"keep"`` adds their raw text in ``_corrupt_record`` and leaves missing fields null, ``"drop"`` leaves them out.
    """
    if (schema is None) == (not infer):
        raise ValueError("give a schema, or ask for inference")
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return _checked(reader, "csv", path, schema, bad_rows)


def _checked(reader: DataFrameReader, kind: str, path: str | Sequence[str], schema: T.StructType,
             bad_rows: str) -> DataFrame:
    if bad_rows == "fail":
        return _all_parsed(reader.schema(schema).option("mode", "FAILFAST").format(kind).load(path), schema)
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    df = _all_parsed(reader.schema(kept).option("columnNameOfCorruptRecord", CORRUPT).format(kind).load(path),
                     schema)
    if bad_rows == "keep":
        return df
    if bad_rows == "drop":
        return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    raise ValueError(f"unknown way to treat bad rows: {bad_rows!r}")


def _all_parsed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The same rows, with every declared column read.

    Spark parses only the columns a query uses and finds a line bad only by those, so a count would see
    other bad lines than a full scan. A condition on all columns, which always holds, keeps them in use.
    """
    # The bound has a random part that is always 0: the optimiser takes a repeatable condition on 20
    # columns for a constraint and rewrites it for every combination of renamed columns.
    least = F.lit(-(2 ** 63)) + F.floor(F.rand())
    return df.where(F.xxhash64(*schema.fieldNames()) >= least)


def scan_months(spark: SparkSession, root: str, kind: str, months: Sequence[str],
                schema: T.StructType | None = None,
                template: str = "{kind}_tripdata_{month}.csv.gz",
                files: int | None = None, gaps: bool = False, bad_rows: str = "fail") -> DataFrame:
    """The monthly files of one kind in one scan, each row with its ``filename``.

    Every month must have its file; ``gaps`` allows some to be absent, but not all. A gzip file is read by a
    single task, so ``files`` can spread the rows before work that costs more than reading.
    """
    wanted = {m: f"{root}/{template.format(kind=kind, month=m)}" for m in months}
    found = {m: p for m, p in wanted.items() if _exists(spark, p)}
    if not found or (len(found) < len(wanted) and not gaps):
        raise FileNotFoundError("no file for " + ", ".join(m for m in wanted if m not in found))
    df = scan_csv(spark, list(found.values()), schema or schemas.TRIP_CSV[kind], bad_rows=bad_rows)
    name = "[^/]*".join(re.escape(part) for part in template.format(kind=kind, month="\x00").split("\x00"))
    df = df.withColumn("filename", F.regexp_extract(F.col("_metadata.file_path"), f"({name})", 1))
    return df.repartition(files) if files else df


def _exists(spark: SparkSession, path: str) -> bool:
    files, hadoop = file_system(spark, path)
    found = files.globStatus(hadoop)
    return found is not None and len(found) > 0


def external_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A table over files that stay where they are: dropping it keeps them."""
    spark.catalog.createTable(name, path=path, source="parquet")
    return spark.table(name)


def scan_events_json(spark: SparkSession, path: str, bad_rows: str = "fail") -> DataFrame:
    """Hourly activity files: one JSON object per line, nested records kept. ``bad_rows`` as in ``scan_csv``."""
    return _checked(spark.read, "json", path, schemas.ACTIVITY_JSON, bad_rows)


def scan_json_pages(spark: SparkSession, path: str, schema: T.StructType, base_page: int = 1,
                    page_pattern: str = r"(\d+)[^/\d]*$") -> DataFrame:
    """Page files, each a JSON array, up to the first empty page.

    ``page_pattern`` finds the page number in the path, by default the last number of the file name. Pages and
    their sizes come from a listing; only files of a few bytes are opened to see whether they are an empty array.
    A page that is missing before the end, or a file without a number, is an error.
    """
    number = F.regexp_extract("path", page_pattern, 1).try_cast("bigint")
    listed = spark.read.format("binaryFile").load(path).select(number.alias("page"), "path", "length")
    blank = F.regexp_replace(F.col("content").cast("string"), r"\s", "").isin("[]", "")
    empty = (spark.read.format("binaryFile").load(path).where(F.col("length") <= _EMPTY_PAGE_BYTES).where(blank)
             .select(number.alias("page")).where(F.col("page") >= base_page).agg(F.min("page")).first()[0])
    pages = F.col("page") if empty is None else F.when(F.col("page") < empty, F.col("page"))
    pages = F.when(F.col("page") >= base_page, pages)
    unnumbered, last, there = listed.agg(F.min(F.when(F.col("page").isNull(), F.col("path"))), F.max(pages),
                                         F.count_distinct(pages)).first()
    if unnumbered is not None:
        raise ValueError(f"no page number in {unnumbered}")
    end = empty if empty is not None else base_page if last is None else last + 1
    if there != end - base_page:
        held = listed.select("page").where(F.col("page") >= base_page).distinct()
        holes = spark.range(base_page, end).withColumnRenamed("id", "page").join(held, "page", "left_anti")
        raise FileNotFoundError(f"missing pages: {[r.page for r in holes.orderBy('page').limit(20).collect()]}")
    rows = (spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
            .withColumn("_page", F.regexp_extract(F.col("_metadata.file_path"), page_pattern, 1).try_cast("bigint")))
    return rows.where(F.col("_page").between(base_page, end - 1)).drop("_page")


def load_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone seed: id, borough, zone and service zone."""
    return scan_csv(spark, path, schemas.ZONES)


def scan_database(spark: SparkSession, url: str, query: str, split_on: str | None = None,
                  low: int | str | None = None, high: int | str | None = None, parts: int = 1,
                  **options: str) -> DataFrame:
    """The result of a query in another database, read over JDBC.

    ``split_on`` names a numeric or time column of the result whose range ``low`` to ``high`` is read in
    ``parts`` tasks; rows outside the range go to the first and last one. Needs the driver of the database
    on the class path.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if split_on is None:
        return reader.option("query", query).load()
    return (reader.option("dbtable", f"({query}) q").option("partitionColumn", split_on)
            .option("lowerBound", low).option("upperBound", high).option("numPartitions", parts)
            .load())


def register(name: str, df: DataFrame) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def describe(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and non-null count, in one pass over the data."""
    fields = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    counted = df.agg(F.count("*").alias("_rows"), *[F.count(n).alias(n) for n, _ in fields])
    lines = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("column_name"),
                 F.lit(t).alias("data_type"), F.col(n).alias("non_null"),
                 F.col("_rows").alias("rows"))
        for i, (n, t) in enumerate(fields, 1)])
    return counted.select(F.inline(lines))


def list_tables(spark: SparkSession, like: str = "*") -> DataFrame:
    """One row per table or view of the current database whose name fits the pattern."""
    return spark.sql(f"SHOW TABLES LIKE '{like}'").select(F.col("tableName").alias("table"), "isTemporary")


def preview(df: DataFrame, rows: int = 10, order: Sequence[str] = ()) -> DataFrame:
    """The first rows: any ones, or the first in an order."""
    return (df.orderBy(*order) if order else df).limit(rows)


def canonical(df: DataFrame, kind: str) -> DataFrame:
    """Exports of the trip tables under the column names of the monthly files."""
    return df.withColumnsRenamed(schemas.RENAMES[kind])


def _snake(name: str) -> str:
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return re.sub(r"_+", "_", re.sub(r"[^0-9A-Za-z]+", "_", name)).strip("_").lower()


def snake_case(df: DataFrame) -> DataFrame:
    """``Trip_Pickup_DateTime`` becomes ``trip_pickup_date_time``."""
    return df.withColumnsRenamed({c: _snake(c) for c in df.columns})
