"""A quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

A text is read as two streams: its words in lower case, and the shapes of its words (runs of capitals, small
letters and digits as one sign each, everything else as it is; a word that repeats the one before it has the shape
``=``). Single and double words of each stream are hashed into one table of weights. The features of a stream's
order are the shares of its n-grams, so a text's length does not matter and texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_slices

BITS = 18
#: About so many labelled rows are learnt from; beyond it, those with the smallest hash of their id.
MAX_TRAINING_ROWS = 20_000
_KNOWN = 200_000
_SHAPES = ((re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[0-9]+"), b"0"))
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_AGAIN = np.uint64(xxhash.xxh64_intdigest(b"=", 1))


def _hashes(word: bytes) -> tuple[int, int]:
    shape = word
    for pattern, sign in _SHAPES:
        shape = pattern.sub(sign, shape)
    return xxhash.xxh64_intdigest(word.lower(), 0), xxhash.xxh64_intdigest(shape, 1)


def ngrams(text: bytes, known: dict[bytes, tuple[int, int]]) -> list[np.ndarray]:
    """Table places of the words, word pairs, shapes and shape pairs of a text, with repeats."""
    words = text.split()
    if not words:
        return []
    if len(known) > _KNOWN:
        known.clear()
    for w in set(words).difference(known):
        known[w] = _hashes(w)
    both = np.array([known[w] for w in words], np.uint64)
    word, shape = both[:, 0], both[:, 1].copy()
    shape[1:][word[1:] == word[:-1]] = _AGAIN
    out = []
    for stream in (word, shape):
        out += [stream, (stream[:-1] * _PAIR ^ stream[1:]) * _PAIR]
    return [(a >> np.uint64(64 - BITS)).astype(np.int64) for a in out if len(a)]


def features(text: bytes, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's sparse vector."""
    parts = ngrams(text, known)
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0)
    places, of = np.unique(np.concatenate(parts), return_inverse=True)
    return places, np.bincount(of, np.concatenate([np.full(len(p), 1 / len(p)) for p in parts]))


class Ftrl:
    """Per-coordinate follow-the-regularised-leader for logistic loss; the last place is the constant."""

    def __init__(self, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0,
                        -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        at, x = np.append(places, 1 << BITS), np.append(values, 1.0)
        w = self.weights(at)
        g = (_sigmoid(float(w @ x)) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def _sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-min(max(x, -35.0), 35.0)))


def in_training_fold(id_col: Column) -> Column:
    """Rows to learn from: crc32 of the id as text leaves a remainder by 5. A row without an id is held out."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 5 != 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = MAX_TRAINING_ROWS, epochs: int = 3, seed: int = 1) -> np.ndarray:
    """The table of weights, learnt from labelled rows of the training fold.

    A document with several labels is learnt with its largest, one with several texts with the least; null labels and ids
    are left out. Features are
    made where the documents lie; the rows of the bounded sample meet in one task, which learns from them in an
    order that their hashes decide. No labelled row: all weights are zero.
    """
    known = (labels.where(in_training_fold(F.col(id_col)) & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias("label")))
    total = known.count()
    draw = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 40))
    if total > max_rows:
        known = known.where(draw < int(max_rows / total * (1 << 40)))

    @F.arrow_udf("binary")
    def vector(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words: dict = {}
        for texts in batches:
            out = []
            for rows in text_slices(texts):
                for t in rows:
                    places, values = features(t or b"", words)
                    out.append(places.astype("<u4").tobytes() + values.astype("<f4").tobytes())
            yield pa.array(out, pa.binary())

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(r["draw"], r["label"], r["x"]) for b in batches for r in b.to_pylist()]
        model = Ftrl()
        for epoch in range(epochs):
            for _, label, x in sorted(rows, key=lambda r: (r[0] * (2 * epoch + 1) % (1 << 40), r[2])):
                half = len(x) // 2
                model.learn(np.frombuffer(x, "<u4", half // 4).astype(np.int64),
                            np.frombuffer(x, "<f4", half // 4, half).astype(float), label)
        yield pa.RecordBatch.from_pydict({"w": [model.weights().astype("<f4").tobytes()]},
                                         pa.schema([("w", pa.binary())]))

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # One row per id (the least text) before features are made: an id with very many rows is still one row to learn from.
    sample = (texts.join(known, "id").groupBy("id", "label").agg(F.min("text").alias("text")).withColumn("draw", draw)
              .select("draw", "label", vector("text").alias("x")))
    found = sample.repartition(1).mapInArrow(fit, "w binary").collect()
    return np.frombuffer(found[0].w, "<f4") if found else np.zeros((1 << BITS) + 1, "<f4")


def score_column(docs: DataFrame, weights: np.ndarray, text: Column) -> Column:
    """The probability of label 1 for each whole text; null and empty texts get that of the constant."""
    table = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** BITS + 1 small floats: 1 MB

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, w = {}, table.value.astype(float)
        for texts in batches:
            yield pa.array([_sigmoid(w[-1] + sum(w[p].mean() for p in ngrams(t or b"", words)))
                            for rows in text_slices(texts) for t in rows], pa.float64())
    return score(text)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = 0.3, **training) -> DataFrame:
    """All columns of ``docs`` and ``held_out``, ``score``, ``predicted``, which replace columns of those names.

    Labels are learnt from the training fold only, and texts are the only input of a score. Null and empty texts
    are scored by the constant. Every row gets a score of its own, so equal texts have equal scores whatever
    their ids; an empty table stays empty.
    """
    weights = train(docs, labels, id_col, text_col, **training)
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("held_out", "score", "predicted")]
    scored = docs.select(*kept, (~in_training_fold(F.col(id_col))).alias("held_out"),
                         score_column(docs, weights, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
