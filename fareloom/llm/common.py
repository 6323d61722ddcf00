"""What several operators share: landed tables, texts in Arrow batches, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, fresh_dir

#: Work on texts goes through slices of about this many bytes of an Arrow batch, whatever its rows weigh.
SLICE_BYTES = 1 << 20

__all__ = ["components", "discard", "land", "text_slices"]


def land(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Writes a frame to the shared folder and reads it again: lineage ends there, and every later job
    sees the same rows in the same files even if executors are lost. Returns the frame and its path."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[list[bytes | None]]:
    """The rows of a string array as UTF-8 bytes, in lists of about ``limit`` bytes (one row at least)."""
    raw = texts.cast(pa.large_binary())
    start, size = 0, 0
    lengths = pa.compute.fill_null(pa.compute.binary_length(raw), 0).to_numpy(zero_copy_only=False)
    for i, n in enumerate(lengths):
        size += int(n)
        if size >= limit:
            yield raw.slice(start, i + 1 - start).to_pylist()
            start, size = i + 1, 0
    if start < len(raw):
        yield raw.slice(start).to_pylist()


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b"))).first()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges ``a``, ``b`` (longs).

    Returns ``node`` and ``component`` (its smallest node) for every node that has an edge to another one.
    Large-star and small-star steps alternate until nothing changes; each round is landed and the one
    before it removed, so neither the lineage nor the disk grows with the rounds. Minima have a map-side
    part. They are landed before edges meet them, so both sides of a join come straight from a shuffle and adaptive
    execution can split the edges of a node that has very many.
    """
    spark = edges.sparkSession
    edges = edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, path = land(edges, "edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least, least_path = land(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large, large_path = land(both.join(least, "a").where("b > a")
                                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct(), "large-star")
        small_least, small_path = land(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(small_least, "a")
        star = (small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                .union(small_least.select("a", F.col("m").alias("b"))).distinct())
        after, new_path = land(star, "edges")
        for old in (path, least_path, large_path, small_path):
            discard(spark, old)
        edges, path = after, new_path
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
