"""64-bit SimHash fingerprints of word shingles, computed batch by batch inside the tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import text_slices

_CHUNK = 1 << 16  # shingles whose bits are counted at once


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 (seed 42) of every run of ``words`` words, in order and with repeats; of all words if fewer."""
    parts = text.lower().split()  # bytes: A-Z only, and split at the six ASCII blanks only
    if not parts:
        return []
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return [digest(b" ".join(parts), 42)]
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate(([0], ends[:-words])).tolist()
    return [digest(joined[a:b], 42) for a, b in zip(starts, (ends[words - 1:] - 1).tolist(), strict=True)]


def simhash(text: bytes, words: int) -> int:
    """A bit is set if it is set in more than half of the shingle hashes. No word: zero."""
    hashes = np.array(shingle_hashes(text, words), dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at:at + _CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def simhash_column(text: Column, words: int) -> Column:
    """The fingerprint as a long with the same bits; a null text counts as empty."""
    @F.arrow_udf("long")
    def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [simhash(t or b"", words) for rows in text_slices(texts) for t in rows]
            yield pa.array(np.array(found, dtype=np.uint64).view(np.int64), pa.int64())
    return fingerprint(text)
