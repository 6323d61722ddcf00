"""Insert-only merge and keyed upsert as joins; the result is written by the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import unmatched


def merge_insert_only(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows plus the source rows whose key the target lacks.

    Rows of the source that share a new key are all inserted: matching looks at the target as it was.
    """
    return target.unionByName(unmatched(source, target, key))


def append_new(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The source rows to append so that loading a file twice changes nothing."""
    return unmatched(source, target, key)


def once_per_key(source: DataFrame, key: Sequence[str]) -> DataFrame:
    """The same rows; the task that meets a key a second time, or a null in a key, fails."""
    bad = F.when(F.col("_rows") > 1, F.lit("more than one source row for a key"))
    for k in key:
        bad = F.when(F.col(k).isNull(), F.lit("a source row without a key")).otherwise(bad)
    counted = source.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(*key))).withColumn("_bad", bad)
    return counted.where(F.when(F.col("_bad").isNull(), True).otherwise(
        F.raise_error(F.col("_bad")).cast("boolean"))).select(*source.columns)


def match_merge(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target and source side by side: structs ``t`` and ``s``, null where a side lacks the key.

    The source must hold a key once (``once_per_key``), so that no key can grow in the join.
    """
    left = target.select(*key, F.struct("*").alias("t"))
    right = source.select(*key, F.struct("*").alias("s"))
    return left.join(right, list(key), "full_outer")


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str], set_columns: Sequence[str],
           mode: str = "replace", unique: bool = False, joined_maps: Sequence[str] = ()) -> DataFrame:
    """Target with matched rows updated and new rows inserted; a repeated source key is an error.

    ``replace`` takes the source value of the set columns, ``add`` adds it to the stored one. ``unique``: the source
    is known to hold every key once and is not checked. Maps in ``joined_maps`` get the entries of both sides, the
    source's where they share a key.
    """
    if mode not in ("replace", "add"):
        raise ValueError(f"unknown mode {mode!r}")
    merged = match_merge(target, source if unique else once_per_key(source, key), key)

    def column(name: str):
        old, new = F.col("t").getField(name), F.col("s").getField(name)
        if name in joined_maps:
            rest = F.map_filter(old, lambda k, _: ~F.coalesce(F.map_contains_key(new, k), F.lit(False)))
            return F.coalesce(F.map_concat(rest, new), old, new)
        if name not in set_columns:
            return F.coalesce(old, new) if name in key else F.when(
                F.col("t").isNotNull(), old).otherwise(new)
        if mode == "add":
            return F.when(F.col("t").isNull() | old.isNull(), new).otherwise(
                old + F.coalesce(new, F.lit(0)))
        return F.when(F.col("s").isNotNull(), new).otherwise(old)

    return merged.select(*[(F.col(c) if c in key else column(c)).alias(c)
                           for c in target.columns])
