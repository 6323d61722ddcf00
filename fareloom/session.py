"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "fareloom", master: str | None = None,
                  partitions: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution on and the web page off.

    ``partitions`` is the shuffle width before adaptive coalescing. On a local master it follows the
    core count; on a cluster leave it to the submitted configuration.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if partitions is None and master.startswith("local["):
            cores = master[len("local["):-1]
            partitions = (os.cpu_count() or 4) if cores == "*" else int(cores)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Finding the Python line of every column expression takes half the time of building a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are wall-clock values; every cast between zoned and plain time assumes UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session that holds for the jobs started inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="fareloom-"))
    return context.getCheckpointDir()


_FOLDERS: dict[str, SparkSession] = {}
_TABLES: set[str] = set()


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used before.

    This module owns it: ``release`` removes it, at the latest when Python ends. Whoever knows earlier that
    no plan reads it any more calls ``discard``.
    """
    path = f"{shared_dir(spark)}/fareloom/{label}-{uuid.uuid4().hex}"
    _FOLDERS[path] = spark
    return path


def fresh_dir_in(root: str, label: str) -> str:
    """A path under ``root`` that nothing has used before. It belongs to the caller and stays."""
    return f"{root}/{label}-{uuid.uuid4().hex}"


def file_path(path: str) -> str:
    """A path as it can be compared: ``file:/a``, ``file:///a`` and ``/a`` are the same."""
    return re.sub(r"^file:/*", "/", path).rstrip("/")


def fresh_name(label: str) -> str:
    """A table or view name that nothing has used before; ``release`` drops it."""
    name = f"fl_{label}_{uuid.uuid4().hex[:12]}"
    _TABLES.add(name)
    return name


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as that system knows it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that no plan reads any more."""
    _FOLDERS.pop(path, None)
    files, hadoop = file_system(spark, path)
    files.delete(hadoop, True)


def release(spark: SparkSession) -> None:
    """Remove all folders and tables made for intermediate results. Frames that read them are void."""
    for name in sorted(_TABLES):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    _TABLES.clear()
    for path in list(_FOLDERS):
        discard(spark, path)


def _release_at_exit() -> None:
    for path, spark in list(_FOLDERS.items()):
        try:
            discard(spark, path)
        except Exception:  # the JVM or the store may be gone already
            return


atexit.register(_release_at_exit)
