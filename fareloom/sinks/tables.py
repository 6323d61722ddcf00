"""Catalog tables on Parquet at a given path, and the layers of models stored as views or tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import discard, file_path, fresh_dir_in


def create_as(name: str, df: DataFrame, path: str) -> DataFrame:
    df.write.mode("errorifexists").format("parquet").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def append(name: str, df: DataFrame) -> DataFrame:
    """Add rows; columns are matched by name, and missing ones become null."""
    table = df.sparkSession.table(name)
    have = {c.lower() for c in df.columns}
    extra = have - {c.lower() for c in table.columns}
    if extra:
        raise ValueError(f"no such column in {name}: {', '.join(sorted(extra))}")
    df.select(*[(F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType)
                .alias(f.name) for f in table.schema.fields]).write.insertInto(name)
    return df.sparkSession.table(name)


def replace(name: str, df: DataFrame) -> DataFrame:
    """Replace all rows, keep the table. ``df`` must not read the table itself."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.insertInto(name, overwrite=True)
    return df.sparkSession.table(name)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
                     for f in schema.fields)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, path: str) -> DataFrame:
    """Create the table if it is absent; an existing one keeps its rows."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema)}) USING parquet LOCATION '{path}'")
    return spark.table(name)


def required(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The same rows, with an error in the writing task if a required column is null."""
    checked = {}
    for f in schema.fields:
        if not f.nullable:
            checked[f.name] = F.when(F.col(f.name).isNull(), F.raise_error(
                F.lit(f"null in required column {f.name}")).cast(f.dataType)).otherwise(
                    F.col(f.name))
    return df.withColumns(checked) if checked else df


def replace_schema(spark: SparkSession, name: str, schema: T.StructType, path: str) -> DataFrame:
    """Drop the table and make it again, empty, at a path that holds nothing yet."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return ensure_table(spark, name, schema, path)


def _location(spark: SparkSession, name: str) -> str | None:
    """Where the files of a table lie; None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    lines = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return lines[0]["data_type"] if lines else None


#: Marks tables that ``materialize`` made, with the folder that holds their files.
_OWNED = "fareloom.materialized"


def _owner(spark: SparkSession, name: str) -> str | None:
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == _OWNED).collect()
    return found[0]["value"] if found else None


def materialize(spark: SparkSession, name: str, build: Callable[[], DataFrame], root: str | None = None) -> DataFrame:
    """Store the result of ``build`` under ``name``; calling it again refreshes the stored rows.

    The files lie in folders of their own under ``root`` (by default a folder of the warehouse) and stay when the
    session ends. The new rows are written completely before the name is pointed at them, so it is never without rows;
    then the old files go, if they lie where this function put them. A name that something else stored, such as an
    external table, is refused before anything is written. Frames made before a refresh must be taken from the table anew.
    """
    there = spark.catalog.tableExists(name)
    owner = _owner(spark, name) if there else None
    if there and owner is None:
        raise ValueError(f"{name} was not stored by materialize")
    root = (root or owner or f"{spark.conf.get('spark.sql.warehouse.dir')}/materialized").rstrip("/")
    path = fresh_dir_in(root, name)
    build().write.parquet(path)
    if not there:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}' TBLPROPERTIES ('{_OWNED}' = '{root}')")
        return spark.table(name)
    old = _location(spark, name)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    if owner != root:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_OWNED}' = '{root}')")
    spark.catalog.refreshTable(name)
    if old and file_path(old).startswith(file_path(owner) + "/"):
        discard(spark, old)
    return spark.table(name)


class Layers:
    """Stores models: views stay plans, tables are written once and read back. ``root`` as in ``materialize``."""

    def __init__(self, spark: SparkSession, prefix: str = "", root: str | None = None):
        self.spark, self.prefix, self.root = spark, prefix, root

    def store(self, name: str, df: DataFrame, kind: str) -> DataFrame:
        name = self.prefix + name
        if kind == "view":
            df.createOrReplaceTempView(name)
            return self.spark.table(name)
        if kind == "table":
            return materialize(self.spark, name, lambda: df, self.root)
        raise ValueError(f"unknown kind {kind!r}")


def model(kind: str, name: str | None = None):
    """Mark a DataFrame function as a model. Called with ``layers=`` it stores its result."""
    def decorate(build: Callable[..., DataFrame]):
        @wraps(build)
        def run(*args, layers: Layers | None = None, **kwargs) -> DataFrame:
            df = build(*args, **kwargs)
            return df if layers is None else layers.store(name or build.__name__, df, kind)
        run.kind = kind
        return run
    return decorate
