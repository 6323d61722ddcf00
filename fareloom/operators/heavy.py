"""Top-k over very many keys: a sketch names candidates, an exact recount and the sketch's bound prove the answer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_dir
from .aggregates import count_by, top_k

#: Keys a sketch tracks, and the groups of tasks whose sketches are merged before all are.
TRACKED = 10_000
TASK_GROUPS = 256
#: Times k: the candidates that are counted exactly.
CANDIDATES = 8


def heavy_candidates(df: DataFrame, key: str, wanted: int, tracked: int = TRACKED) -> tuple[list, float]:
    """The ``wanted`` keys with the largest estimates at most, and a bound on the rows of any other key.

    A sketch of ``tracked`` keys has at least 4 / 3 as many slots, so an estimate exceeds the true count by 3.5 x 3 / 4
    rows / ``tracked`` at most and never falls short of it. A key left out is untracked, or was not told from noise (twice
    that error at most), or has an estimate below the last one returned. Sketches are merged in two levels, so that no
    task takes one of every other task.
    """
    parts = (df.where(F.col(key).isNotNull())
             .groupBy(F.pmod(F.spark_partition_id(), F.lit(TASK_GROUPS)).alias("tasks"))
             .agg(F.call_function("approx_top_k_accumulate", F.col(key), F.lit(tracked)).alias("state"),
                  F.count(F.lit(1)).alias("n")))
    # A second level of groups, by a constant, so that no rows give no group: sketches of nothing cannot be combined.
    state = F.call_function("approx_top_k_combine", F.col("state"), F.lit(tracked))
    top = parts.groupBy(F.lit(0).alias("all")).agg(
        F.call_function("approx_top_k_estimate", state, F.lit(wanted)).alias("found"), F.sum("n").alias("rows")).first()
    if top is None:
        return [], 0.0
    found, rows = top["found"], top["rows"]
    estimates = [r["count"] for r in found]
    last = estimates[-1] if len(estimates) == wanted else 0
    return [r["item"] for r in found], max(last, 2 * 3.5 * 0.75 * rows / tracked)


def top_k_by_count(df: DataFrame, key: str, k: int, tracked: int = TRACKED, name: str = "count") -> DataFrame:
    """The ``k`` keys with the most rows, ties in the order of the key; exact, whatever the distribution.

    The keys are not shuffled: the first pass sketches them, the second counts the candidates only. The answer stands if
    the last candidate taken has more rows than any other key can have; else (many keys of like counts, a tie at the edge)
    all keys are counted. Null is a key like any other and always counted. Both passes read the key column only.
    """
    if k < 1 or CANDIDATES * k > tracked:
        raise ValueError(f"k must lie between 1 and {tracked // CANDIDATES}, or more keys be tracked")
    keys = df.select(key)
    items, bound = heavy_candidates(keys, key, CANDIDATES * k, tracked)
    named = keys.where(F.col(key).isNull() | F.col(key).isin(items)) if items else keys.where(F.col(key).isNull())
    top = top_k(count_by(named, [key], name=name), name, k, [key])
    path = fresh_dir(df.sparkSession, "heavy")
    top.coalesce(1).write.parquet(path)
    top = df.sparkSession.read.schema(top.schema).parquet(path)
    taken, least = top.agg(F.count(F.lit(1)), F.min(name)).first()
    if (least if taken == k else 1) > bound:
        return top.orderBy(F.desc(name), key)
    return top_k(count_by(keys, [key], name=name), name, k, [key])
