"""Joins to dimensions and key lookups.

No broadcast is forced on data that can grow: Spark compares the measured size of a side with its own
threshold, and adaptive execution splits hot partitions of sort-merge joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dim(df: DataFrame, dim: DataFrame, fk: str, pk: str, columns: list[str],
             how: str = "inner") -> DataFrame:
    """Bring ``columns`` of a dimension to the rows that refer to it."""
    side = dim.select(F.col(pk).alias("_pk"), *columns)
    return df.join(side, F.col(fk) == F.col("_pk"), how).drop("_pk")


def role_join(df: DataFrame, dim: DataFrame, roles: dict[str, str], pk: str,
              columns: list[str]) -> DataFrame:
    """Join one dimension once per role; role ``pickup`` gives columns ``pickup_<column>``."""
    for role, fk in roles.items():
        side = dim.select(F.col(pk).alias(f"_{role}_pk"),
                          *[F.col(c).alias(f"{role}_{c}") for c in columns])
        df = df.join(side, F.col(fk) == F.col(f"_{role}_pk")).drop(f"_{role}_pk")
    return df


def unmatched(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows whose key the target does not have, duplicates and null keys included.

    Rows without a key match nothing and go past the join, so they never meet in one task. A key that holds
    many source rows is split by adaptive execution.
    """
    keyed = source.where(F.col(key).isNotNull()).join(target.select(key), key, "left_anti")
    return keyed.select(*source.columns).union(source.where(F.col(key).isNull()))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child keys without a parent, with their row counts.

    The child is counted by key before the join, so one key never means more than one joined row.
    """
    keys = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("rows"))
    return keys.join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
