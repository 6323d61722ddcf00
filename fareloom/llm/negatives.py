"""Hard-negative mining by threshold joins between a stated set of anchors and all rows.

Rows lie in shards of bounded size, those with equal vectors in different ones. A task gets one shard and streams
anchors through it in batches. Each batch is a threshold join in the manner of L2AP:

* Dimensions are ordered by their share of the shard's squares and taken in blocks. A row is left out of the lists of
  all blocks from the first one on where the norm of its remaining components, times the largest norm of an anchor,
  stays below the lowest threshold of the batch: what is left out cannot carry a pair over the threshold.
* Block by block, the lists add to the partial scores. A pair is dropped when its partial score and the product of the
  remaining norms stay below the anchor's threshold. The few pairs left get their exact score.

An anchor's windows (``least`` to ``most``, with room for ``k`` rows) are filled from the top: the threshold begins high in
the window and is lowered, for the anchors whose windows are not full, until they are or its lower end is reached.
Each anchor does that in one shard first. The k-th score found there, or the lower end, is its threshold in all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, land

SHARD_ROWS = 1 << 14
SLICE_ANCHORS = 1 << 16
BLOCK = 16
BATCH = 128
#: Where in a window its threshold stands, one try after the other.
STEPS = (0.9, 0.75, 0.5, 0.25)
_SLACK = 1e-9
_EXACT = float(1 << 53)
_TOP = (1 << 63) - 1
_GROUP = ["dim", "kept", "shard", "slice"]


def scaled(vector: Column, scale: float) -> Column:
    """floor(scale x) of each component, as packed doubles; null for vectors that are null, empty or hold a null or
    non-finite component. A component that leaves the doubles by the scaling is an error."""
    @F.arrow_udf("binary")
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            out = []
            for v in vectors:
                x = np.array(v.values.to_numpy(zero_copy_only=False), np.float64) if v.is_valid else np.zeros(0)
                if not len(x) or not np.isfinite(x).all():
                    out.append(None)
                    continue
                with np.errstate(over="ignore"):
                    q = np.floor(scale * x)
                if not np.isfinite(q).all():
                    raise ValueError("a component is too large to be scaled")
                out.append(q.astype("<f8").tobytes())
            yield pa.array(out, pa.binary())
    return pack(vector.cast("array<double>"))


def _rest(x: np.ndarray, edges: list[int]) -> np.ndarray:
    """Norms of the components from each edge on; the last one is 0."""
    squares = np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(x), 1))], axis=1))[:, edges]


class Shard:
    """Rows of one shard, and threshold joins with batches of anchors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.dims = np.argsort(-(x * x).sum(0), kind="stable")
        self.edges = [*range(0, x.shape[1], BLOCK), x.shape[1]]
        self.ids, self.labels, self.x = ids, labels, np.ascontiguousarray(x[:, self.dims])
        self.rest = _rest(self.x, self.edges)
        self.longest = float(self.rest[:, 0].max(initial=0))
        self.big = float(np.abs(x).max(initial=0))

    def join(self, q: np.ndarray, ids: np.ndarray, labels: np.ndarray, least: np.ndarray, same: bool):
        """(anchor, row, score) of all pairs with a score of ``least`` (one per anchor) or more, with an equal or an
        unequal label, and another id. ``q`` has its dimensions in the order of the shard."""
        blocks, rest_q = len(self.edges) - 1, _rest(q, self.edges)
        lowest, longest = least.min(), rest_q[:, 0].max()
        listed = np.where(self.rest[:, :-1] * longest * (1 + _SLACK) < lowest, 0, 1).sum(1)
        order = np.argsort(-listed, kind="stable")
        order = order[:np.searchsorted(-listed[order], 0)]  # a row without a list takes no part
        x, rest, listed = self.x[order], self.rest[order], listed[order]
        ok = (labels[:, None] == self.labels[order]) == same
        ok &= ids[:, None] != self.ids[order]
        partial = np.zeros((len(q), len(order)))
        slack = rest_q[:, :1] * rest[:, 0] * _SLACK
        for b in range(blocks):
            n = np.searchsorted(-listed, -b)  # rows in the lists of this block
            a, z = self.edges[b], self.edges[b + 1]
            partial[:, :n] += q[:, a:z] @ x[:n, a:z].T
            bound = partial[:, :n] + rest_q[:, b + 1:b + 2] * rest[:n, b + 1] + slack[:, :n]
            ok[:, :n] &= ~(bound < least[:, None])
            if np.count_nonzero(ok) < ok.size // 64:
                break
        at, row = np.nonzero(ok)
        score = np.empty(len(at), float if self._exact(q) else object)
        for i in range(0, len(at), 1 << 16):
            score[i:i + (1 << 16)] = self._scores(q[at[i:i + (1 << 16)]], x[row[i:i + (1 << 16)]])
        keep = np.array(score >= least[at], bool)
        return at[keep], order[row[keep]], score[keep]

    def _exact(self, q: np.ndarray) -> bool:
        return self.big * float(np.abs(q).max(initial=0)) * q.shape[1] < _EXACT

    def _scores(self, q: np.ndarray, x: np.ndarray):
        if self._exact(q):
            return np.einsum("ij,ij->i", q, x)
        return np.array([sum(int(a) * int(b) for a, b in zip(u, v)) for u, v in zip(q.tolist(), x.tolist())], object)

    def fill(self, q: np.ndarray, ids: np.ndarray, labels: np.ndarray, windows: list[list[tuple]], k: int, lower: bool, same: bool):
        """(anchor id, window, row id, score): the first ``k`` rows of each window. ``windows``: per anchor, pairs
        (least, most), either of them None for no bound. ``lower``: try high thresholds first."""
        q = q[:, self.dims]
        reach = [float(r) for r in (np.sqrt((q * q).sum(1)) * self.longest * (1 + _SLACK) + 1).tolist()]
        spans = [[(-reach[i] if a is None else a, _TOP if b is None else b) for a, b in w] for i, w in enumerate(windows)]
        todo, out = np.arange(len(q)), []
        for step in (*(STEPS if lower else ()), 0.0):
            least = np.array([min(a + max(0.0, min(b, reach[i]) - a) * step for a, b in spans[i]) if step else min(a for a, _ in spans[i])
                              for i in todo], object).astype(float)
            at, row, score = self.join(q[todo], ids[todo], labels[todo], least, same)
            order = np.lexsort((self.ids[row], -score, at))
            at, row, score = at[order], row[order], score[order]
            starts = np.searchsorted(at, np.arange(len(todo) + 1))
            again = []
            for j, i in enumerate(todo.tolist()):
                some = slice(starts[j], starts[j + 1])
                found = []
                for w, (a, b) in enumerate(spans[i]):
                    inside = np.flatnonzero((score[some] >= a) & (score[some] <= b))[:k] + starts[j]
                    found += [(int(ids[i]), w, int(self.ids[row[p]]), int(score[p])) for p in inside.tolist()]
                    if step and len(inside) < k:
                        again.append(i)
                        break
                else:
                    out += found
            todo = np.array(again, int)
            if not len(todo):
                break
        return out


def _search(k: int, same: bool, lower: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts, shard = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in (*_GROUP, "kind")], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                *key, kind = keys[a].tolist()
                if key != held:
                    held, parts, shard = key, [], None
                part = batch.slice(a, b - a)
                ids, labels = (part.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
                x = np.frombuffer(b"".join(part.column("v").to_pylist()), "<f8").reshape(-1, key[0])
                if kind == 0:
                    parts.append((ids, labels, x))
                    continue
                if shard is None:
                    if not parts:
                        continue
                    shard, parts = Shard(*map(np.concatenate, zip(*parts))), []
                windows = [[(w["least"], w["most"]) for w in ws] for ws in part.column("windows").to_pylist()]
                for i in range(0, len(x), BATCH):
                    some = slice(i, i + BATCH)
                    out = shard.fill(x[some], ids[some], labels[some], windows[some], k, lower, same)
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                         ["anchor_id", "window", "vec_id", "score"])
    return run


def _first(rows: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """(anchor_id, window, vec_id, score, rank): the first ``k`` rows of every window of all anchors.

    ``rows`` and ``anchors`` have ``dim``, ``kept`` (what an anchor and its rows must have in common), ``shards`` and
    ``slices`` of that, ``vec_id``, ``label``, ``v``; anchors also ``windows``.
    """
    kind = "array<struct<least:bigint,most:bigint>>"
    lot = F.pmod("lot", F.col("shards")).cast("int")
    searched = rows.select("dim", "kept", lot.alias("shard"), F.explode(F.sequence(F.lit(0), F.col("slices").cast("int") - 1)).alias("slice"),
                           F.lit(0).alias("kind"), "vec_id", "label", "v", F.lit(None).cast(kind).alias("windows"))
    asked = anchors.select("dim", "kept", "shards", F.pmod(F.xxhash64("vec_id", F.lit(1)), "shards").cast("int").alias("home"),
                           F.pmod(F.xxhash64("vec_id", F.lit(2)), "slices").cast("int").alias("slice"), F.lit(1).alias("kind"),
                           "vec_id", "label", "v", F.col("windows").cast(kind).alias("windows"))

    def search(asked: DataFrame, lower: bool) -> DataFrame:
        met = searched.union(asked.select(searched.columns)).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "kind")
        return met.mapInArrow(_search(k, same, lower), "anchor_id long, window long, vec_id long, score long")
    home, _ = land(search(asked.withColumn("shard", F.col("home")), True), "negatives-home")
    full = home.groupBy("anchor_id", "window").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(f"n >= {k}")
    least = (full.groupBy(F.col("anchor_id").alias("vec_id"))
             .agg(F.map_from_entries(F.collect_list(F.struct(F.col("window").cast("int"), "least"))).alias("found")))
    windows = F.transform("windows", lambda w, i: F.struct(F.coalesce(F.try_element_at("found", i), w["least"]).alias("least"),
                                                           w["most"].alias("most")))
    others = (asked.join(least, "vec_id", "left")
              .withColumn("windows", F.when(F.col("found").isNull(), F.col("windows")).otherwise(windows))
              .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards").cast("int") - 1))).where("shard != home"))
    found = home.union(search(others, False))
    rank = F.expr("row_number() over (partition by anchor_id, window order by score desc, vec_id)")
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, lower: int = 50, upper: int = 95,
                   scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   shard_rows: int = SHARD_ROWS, slice_anchors: int = SLICE_ANCHORS) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (int, from 1), ``negative_id``, ``positive_score``, ``negative_score``.

    Scores are inner products of ``floor(scale x)``. The positives of an anchor (a row that the condition ``anchors`` picks)
    are its first ``positives`` other rows of the same label by score, ties by smaller id; for each, the first
    ``negatives`` rows of another label whose score is ``lower`` to ``upper`` percent of the positive's. A positive of
    negative score has an empty window.

    Rows without an id or a label and vectors that are null, empty, or hold a null or non-finite component take no part;
    vectors are compared with those of as many components. A repeated row takes a place for each of its rows, but rows
    with the anchor's id are never its own partners; an id that is an anchor several times is one, with its smallest
    vector and label. Scores are exact; one that does not fit 64 bits is an error if it is to be returned. Empty tables,
    and conditions that pick nothing, give an empty result. Other columns are not read.
    """
    spread = F.xxhash64(F.monotonically_increasing_id())  # equal rows go to different shards
    rows, path = land(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                                     scaled(F.col(vector_col), scale).alias("v"), spread.alias("lot"),
                                     F.coalesce(anchors, F.lit(False)).alias("asks"))
                      .where("vec_id is not null and label is not null and v is not null")
                      .withColumn("dim", (F.octet_length("v") / 8).cast("int")), "vectors")
    asked, asked_path = land(rows.where("asks").groupBy("vec_id").agg(F.min(F.struct("v", "label", "dim")).alias("q"))
                             .select("vec_id", "q.*"), "anchors")

    def sized(counts: DataFrame) -> DataFrame:
        return counts.select("dim", "kept", F.greatest(F.lit(1), F.ceil(F.col("n") / shard_rows)).alias("shards"),
                             F.greatest(F.lit(1), F.ceil(F.col("m") / slice_anchors)).alias("slices"))
    # Positives: only rows of the anchor's label. Labels without an anchor are not searched.
    counts, counts_path = land(sized(rows.groupBy("dim", F.col("label").alias("kept")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("m")).where("m > 0")), "label-counts")
    by_label = rows.withColumn("kept", F.col("label")).join(counts, ["dim", "kept"])
    one = F.array(F.struct(F.lit(None).cast("long").alias("least"), F.lit(None).cast("long").alias("most")))
    found = _first(by_label, asked.withColumn("kept", F.col("label")).withColumn("windows", one).join(counts, ["dim", "kept"]),
                   positives, True)
    pairs, pairs_path = land(found.select("anchor_id", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"),
                                          F.col("score").alias("positive_score")), "positives")
    # Negatives: all rows, for all windows of an anchor at once.
    total, asking = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    of_all = {"kept": F.lit(0).cast("long"), "shards": F.lit(max(1, -(-total // shard_rows))).cast("long"),
              "slices": F.lit(max(1, -(-asking // slice_anchors))).cast("long")}

    def percent(p: int) -> str:  # the whole part of p percent, without leaving 64 bits on the way
        return f"(positive_score div 100 * {p} + positive_score % 100 * {p} div 100)"
    over = f"if(positive_score % 100 * {lower} % 100 > 0, 1, 0)"
    windows = (pairs.where("positive_score >= 0").groupBy(F.col("anchor_id").alias("vec_id"))
               .agg(F.sort_array(F.collect_list(F.struct("place", F.expr(f"{percent(lower)} + {over}").alias("least"),
                                                         F.expr(percent(upper)).alias("most")))).alias("windows")))
    hard = _first(rows.withColumns(of_all), asked.join(windows.select("vec_id", F.expr(
        "transform(windows, w -> struct(w.least as least, w.most as most))").alias("windows")), "vec_id").withColumns(of_all), negatives, False)
    # Positives of negative score come last, so the number of a window is the place of its positive.
    result, _ = land(hard.select("anchor_id", (F.col("window") + 1).cast("int").alias("place"), "rank", F.col("vec_id").alias("negative_id"),
                                 F.col("score").alias("negative_score")).join(pairs, ["anchor_id", "place"])
                     .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives")
    for old in (path, asked_path, counts_path, pairs_path):
        discard(vectors.sparkSession, old)
    return result
