"""Exact top-k search by inner product over KD-trees, one per shard.

Shards have a bounded number of rows. A task builds the tree of its shard (splits at the median of the widest
side, boxes tight around their rows) and then streams queries through it: nodes are taken best first by the
largest inner product that any point of their box can have with the query, and the search ends when that bound
falls below the k-th score known. Each query first visits one shard; the k-th score found there travels with it to
all others, which cut off below it from the start and return only rows that reach it.

Queries are dealt out in slices of bounded size, and a shard's rows go once to each slice: all queries meet all
rows block by block, and no task holds more than one shard's rows and one batch of queries.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import land

SHARD_ROWS = 1 << 14
SLICE_QUERIES = 1 << 16
LEAF_ROWS = 64
SCALE = 1024.0
_EXACT = float(1 << 53)


def quantised(vector: Column) -> Column:
    """floor(1024 x) of each component as packed 64-bit integers; null for null or empty vectors and those with
    a null or non-finite component. A finite component whose result has 62 bits or more is an error: no score of its
    row need fit into 64 bits, and leaving the row out would change the others' ranks unseen."""
    @F.arrow_udf("binary")
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            out = []
            for v in vectors:
                x = np.array(v.values.to_numpy(zero_copy_only=False), np.float64) if v.is_valid else np.zeros(0)
                if not len(x) or not np.isfinite(x).all():
                    out.append(None)
                    continue
                q = np.floor(SCALE * x)
                if np.abs(q).max() >= 1 << 62:
                    raise ValueError(f"component {x[np.abs(x).argmax()]} is too large for integer scores")
                out.append(q.astype("<i8").tobytes())
            yield pa.array(out, pa.binary())
    return pack(vector.cast("array<double>"))


class Tree:
    """A KD-tree over integer vectors. Nodes are rows of ``lo`` and ``hi`` (their boxes) and ``span`` (rows from,
    to) in the order of ``x``; ``kids`` holds the first of two children or -1."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.big = float(np.abs(x).max(initial=0))
        order = np.arange(len(x))
        lo, hi, span, kids, at = [], [], [(0, len(x))], [], 0
        while at < len(span):
            a, b = span[at]
            rows = x[order[a:b]]
            lo.append(rows.min(0))
            hi.append(rows.max(0))
            side = (hi[-1] - lo[-1]).argmax()
            if b - a > leaf_rows and hi[-1][side] > lo[-1][side]:
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(rows[:, side], middle)]
                kids.append(len(span))
                span += [(a, a + middle), (a + middle, b)]
            else:
                kids.append(-1)
            at += 1
        self.lo, self.hi, self.span, self.kids = np.array(lo, float), np.array(hi, float), span, kids
        self.ids, self.x = ids[order], x[order]
        self.xf = self.x.astype(float)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """For each query and node, the largest inner product that the node's box allows."""
        q = q.astype(float)
        out = np.maximum(q, 0) @ self.hi.T + np.minimum(q, 0) @ self.lo.T
        return out if self._exact(q) else out + np.abs(out) * 1e-9 + np.abs(q).sum(1, keepdims=True) * self.big * 1e-9

    def _exact(self, q: np.ndarray) -> bool:
        return self.big * float(np.abs(q).max(initial=0)) * q.shape[-1] < _EXACT

    def top(self, query: int, q: np.ndarray, bounds: list[float], k: int, floor: int | None) -> list[tuple[int, int]]:
        """(score, id) of the k best rows that reach ``floor``, best first, smaller ids first among equals."""
        exact = self._exact(q)
        qf = q.astype(float)
        best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst is on top
        least = -math.inf if floor is None else floor
        queue = [(-bounds[0], 0)]
        while queue and -queue[0][0] >= least:
            _, node = heapq.heappop(queue)
            kid = self.kids[node]
            if kid >= 0:
                for child in (kid, kid + 1):
                    if bounds[child] >= least:
                        heapq.heappush(queue, (-bounds[child], child))
                continue
            a, b = self.span[node]
            scores = self.xf[a:b] @ qf if exact else np.array(self.x[a:b].astype(object) @ q.astype(object))
            for i in np.flatnonzero(scores >= least).tolist():
                found = (int(scores[i]), -int(self.ids[a + i]))
                if found[1] == -query:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
            if len(best) == k:
                least = max(least, best[0][0])
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, rows, tree = None, [], [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("dim", "shard", "slice", "kind")], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                *key, kind = keys[a].tolist()
                if key != held:
                    held, ids, rows, tree = key, [], [], None
                part = batch.slice(a, b - a)
                vec = part.column("vec_id").to_numpy(zero_copy_only=False)
                x = np.frombuffer(b"".join(part.column("v").to_pylist()), "<i8").reshape(-1, key[0])
                if kind == 0:
                    ids.append(vec)
                    rows.append(x)
                    continue
                if tree is None:
                    if not rows:
                        continue
                    tree, ids, rows = Tree(np.concatenate(ids), np.concatenate(rows)), [0], []
                floors = part.column("least").to_pylist()
                out = []
                for at in range(0, len(x), 512):
                    bounds = tree.bounds(x[at:at + 512]).tolist()
                    for i in range(at, min(at + 512, len(x))):
                        out += [(int(vec[i]), i_, s) for s, i_ in tree.top(int(vec[i]), x[i], bounds[i - at], k, floors[i])]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                     ["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          shard_rows: int = SHARD_ROWS, slice_queries: int = SLICE_QUERIES) -> DataFrame:
    """``query_id``, ``rank`` (int, from 1), ``vec_id``, ``score`` (long): for every row that the condition
    ``queries`` picks, its ``k`` rows of highest inner product of quantised components, all if there are fewer.

    Candidates are all rows with another id and as many components; equal scores go to the smaller id. Rows
    without an id and vectors that are null, empty, or hold a null, non-finite or overlong component take no
    part. A repeated candidate takes a rank for each of its rows; an id queried several times is queried once, with its
    smallest vector. Scores are exact as long as they fit 64 bits. Empty tables and conditions that pick nothing
    give an empty result; other columns are not read.
    """
    spread = F.xxhash64(F.monotonically_increasing_id())  # equal rows go to different shards
    rows, _ = land(vectors.select(F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col)).alias("v"),
                                  spread.alias("lot"), F.coalesce(queries, F.lit(False)).alias("asks"))
                   .where("vec_id is not null and v is not null")
                   .withColumn("dim", (F.octet_length("v") / 8).cast("int")), "vectors")
    asked = rows.where("asks").groupBy("vec_id").agg(F.min(F.struct("v", "dim")).alias("q")).select("vec_id", "q.*")
    total, asking = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    shards, slices = max(1, -(-total // shard_rows)), max(1, -(-asking // slice_queries))
    searched = (rows.select("dim", F.pmod("lot", F.lit(shards)).cast("int").alias("shard"),
                            F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
                            F.lit(0).alias("kind"), "vec_id", "v", F.lit(None).cast("long").alias("least")))
    asked = asked.select("dim", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int").alias("home"),
                         F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(slices)).cast("int").alias("slice"),
                         F.lit(1).alias("kind"), "vec_id", "v")
    place = ["dim", "shard", "slice"]

    def search(asked: DataFrame) -> DataFrame:
        met = searched.union(asked.select(searched.columns)).repartition(*place).sortWithinPartitions(*place, "kind")
        return met.mapInArrow(_search(k), "query_id long, vec_id long, score long")

    first, _ = land(search(asked.select("*", F.col("home").alias("shard"), F.lit(None).cast("long").alias("least"))),
                    "first-shard")
    found = first
    if shards > 1:
        least = (first.groupBy(F.col("query_id").alias("vec_id"))
                 .agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least")))
        others = (asked.join(least, "vec_id", "left")
                  .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard != home"))
        found = first.union(search(others))
    rank = F.expr("row_number() over (partition by query_id order by score desc, vec_id)")
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
