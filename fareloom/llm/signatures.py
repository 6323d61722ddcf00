"""Order MinHash: signatures of texts that notice moved text as well as missing text.

The ``GRAM`` code points from each place of a text are a k-mer; one that occurred before in the text gets the number of its
occurrence, so that all of them differ. Each of ``SKETCHES`` hash functions selects the ``PICKED`` smallest of these numbered
k-mers, which are then put in the order of the text and hashed as a tuple. Two texts agree in a sketch if they share the
selected k-mers *and* have them in the same order; the share of equal sketches is their likeness, which bounds the
edit distance of the texts as MinHash bounds the overlap of their sets.

``with_next`` brings each row together with the next one in the order of ids: rows are dealt to ranges of ids, the
first row of each range also goes to the range before, and every task streams through its range in order.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import text_slices

GRAM = 8
SKETCHES = 64
PICKED = 2
#: Numbered k-mers that the hash functions look at together; longer texts take several turns.
_CHUNK = 2048
_DIGITS = 4
_EMPTY = "0" * (_DIGITS * SKETCHES)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = _mix(np.arange(1, 2 * SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
# Ranks have 32 bits, which processors compare eight at a time; k-mers of equal rank go by their place.
_ADD, _TIMES = ((_SEEDS >> np.uint64(32)).astype(np.uint32).reshape(2, SKETCHES, 1) | np.uint32(1))


def numbered_kmers(text: str) -> np.ndarray:
    """A 64-bit hash of the k-mer and its occurrence number for each place of the text, in order."""
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    width, power = 1, 0x100000001B3
    while width < GRAM and len(x) > width:  # hashes of two neighbours make one of twice the width
        x = x[:-width] * np.uint64(power) + x[width:]
        power, width = power * power % (1 << 64), 2 * width
    x = _mix(x)
    order = np.argsort(x, kind="stable")
    ranked = x[order]
    first = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    if first.all():
        return x
    at = np.arange(len(x))
    number = np.empty(len(x), np.uint64)
    number[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return _mix(x + number * np.uint64(0x9E3779B97F4A7C15))


def signature(text: str) -> str:
    """``SKETCHES`` times ``_DIGITS`` hexadecimal digits. A text shorter than a k-mer is one k-mer; the empty text has all zeros."""
    if not text:
        return _EMPTY
    kmers = numbered_kmers(text)
    short, rows, found, place = (kmers >> np.uint64(32)).astype(np.uint32), np.arange(SKETCHES), [], []
    for a in range(0, len(kmers), _CHUNK):
        ranks = short[a:a + _CHUNK] ^ _ADD
        ranks *= _TIMES
        for _ in range(min(PICKED, ranks.shape[1])):
            i = ranks.argmin(1)
            found.append(ranks[rows, i])
            place.append(i + a)
            ranks[rows, i] = ~np.uint32(0)
    best = np.argsort(np.stack(found, 1), axis=1, kind="stable")[:, :PICKED]
    place = np.take_along_axis(np.stack(place, 1), best, 1)
    picked = kmers[np.sort(place, axis=1)]
    code = np.zeros(SKETCHES, np.uint64)
    for i in range(picked.shape[1]):
        code = _mix(code * np.uint64(31) + picked[:, i])
    return (code >> np.uint64(48)).astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """The share of equal sketches, 0 to 1. The empty text is like itself only."""
    if a == _EMPTY or b == _EMPTY:
        return float(a == b)
    x, y = (np.frombuffer(bytes.fromhex(s), "<u2") for s in (a, b))
    return float((x == y).mean())


def signatures(text: Column) -> Column:
    """The signature of each text; a null text counts as empty."""
    @F.arrow_udf("string")
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([signature((t or b"").decode("utf-8", "replace")) for some in text_slices(texts) for t in some], pa.string())
    return sign(text)


@lru_cache(maxsize=2)
def _remembered(text: str) -> str:
    return signature(text)


def with_next(docs: DataFrame, row: Callable, fields: str, id_col: str = "doc_id", text_col: str = "text",
              ranges: int | None = None) -> DataFrame:
    """One row per row of ``docs``, made by ``row(id, text, next text)``, with the next one by descending id.

    ``fields``: the columns that ``row`` returns as a tuple, as DDL. Rows without an id come last; rows of one id come in
    the order of their text's hash, so that an id with very many rows is split over ranges too. After the last row
    comes the first; a single row is its own next one.
    """
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # (0, -id) rises as ids fall; rows without an id are (1, 0).
    keyed = keyed.select("id", "text", F.col("id").isNull().cast("long").alias("k1"),
                         F.coalesce(F.bitwise_not("id"), F.lit(0).cast("long")).alias("k2"), F.xxhash64("text").alias("k3"))
    order = ["k1", "k2", "k3"]
    # The first row of each range, in order: one row per range goes to the driver.
    firsts = [tuple(r.f) for r in keyed.select(*order).repartitionByRange(ranges, *order)
              .groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(*order)).alias("f")).collect()]
    firsts.sort()

    @F.arrow_udf("int")
    def range_of(k1: pa.Array, k2: pa.Array, k3: pa.Array) -> pa.Array:
        return pa.array([bisect_right(firsts, k) - 1 for k in zip(*(k.to_pylist() for k in (k1, k2, k3)))], pa.int32())
    own = keyed.withColumn("range", range_of(*order)).select("range", F.lit(0).alias("extra"), "id", "text", *order)
    # Of the rows that share the first key of a range one also ends the range before; as many rows as there are ranges.
    n = max(len(firsts), 1)
    listed = spark.createDataFrame([(*f, (i - 1) % n) for i, f in enumerate(firsts)], "k1 long, k2 long, k3 long, range int")
    ends = (keyed.join(F.broadcast(listed), order).groupBy("range", *order).agg(F.first("id").alias("id"), F.first("text").alias("text"))
            .select("range", F.lit(1).alias("extra"), "id", "text", *order))
    streamed = (own.union(ends).repartitionById(ranges, F.col("range")).sortWithinPartitions("range", "extra", *order)
                .select("range", "extra", "id", "text"))
    schema = to_arrow_schema(StructType.fromDDL(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            place = zip(*(batch.column(c).to_pylist() for c in ("range", "extra", "id")))
            for texts in text_slices(batch.column("text")):
                out = []
                for raw in texts:
                    (r, extra, key), text = next(place), raw.decode("utf-8", "replace")
                    if held is not None and held[0] == r:
                        out.append(row(held[1], held[2], text))
                    held = None if extra else (r, key, text)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema.names)
    return streamed.mapInArrow(run, fields)


def replace_last_third(text: str, after: str) -> str:
    """The last third of the code points (rounded down) replaced by as many of ``after``, or all of it."""
    m = len(text) // 3
    return text[:len(text) - m] + after[:m]


def fingerprint_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          edit: Callable[[str, str], str] = replace_last_third) -> DataFrame:
    """Every row's signature, that of its text after an edit that takes its next document, and how like they are.

    Returns ``doc_id``, ``n_chars`` (code points), ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``
    and ``near_next`` (likeness to the edited text and to the next document, by descending id; after the last comes the
    first). Texts are read whole, whatever their length. Null texts count as empty; the signature of an empty text is all
    zeros and is like that of other empty texts only. Equal texts have equal signatures. Repeated rows are each other's
    next ones; rows without an id come last, with a null id. Bytes that are not UTF-8 count as U+FFFD. An empty table
    gives an empty result; other columns are not read.
    """
    def row(key: int | None, text: str, after: str) -> tuple:
        # The next row's text comes again as the row itself: one signature serves both.
        edited = edit(text, after)
        own, changed, following = _remembered(text), signature(edited), _remembered(after)
        return (key, len(text), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), own, changed,
                likeness(own, changed), likeness(own, following))
    return with_next(docs, row, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                "near_edited double, near_next double", id_col, text_col)
