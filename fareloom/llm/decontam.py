"""Benchmark decontamination: edit distance by CGK embedding, bit sampling and exact verification.

Texts are sequences of words. A window of an item's size class is embedded by a random walk: at step j the walk
writes down the word it stands on and moves on if bit j of that word's hash is set. Windows at a small edit
distance thus become sequences at a small Hamming distance. Each repetition draws a walk of its own and samples
``SAMPLED`` steps of it as a key; windows of texts and windows of items with equal keys are candidates.

An item of L words is cut into windows of W words, W being a power of two of at most (2 L + 2) / 3 and
``MAX_WINDOW``, at every offset; texts are cut at every W / 2 words, so any occurrence of the item holds such a
window of the text whole. Walks over long windows drift apart as edits add up, so windows do not grow with the
item: a long item has more of them, some with few edits, and any one may nominate a candidate.
Candidates that share enough words with the item (a bound that no true match fails) are verified by exact
alignment of the whole item with the text around the candidate.

The target is a recall of 0.95 for items of 12 words or more with a fifth of their words edited. Measured on random items
of a skewed vocabulary (100 passages a length, 40 from 400 words on): 0.96 at 12 words, 0.97 at 23, 1.00 at 17, 22, 30, 37,
46, 57, 100, 200, 400 and 1000 words; at 10 % edits and less 1.00 throughout. Shorter items, 300 each, with
twice the walks up to 10 words: 0.95 at 5 words, 1.00 at 6, 8, 9 and 10, 0.93 at 11, the one length that falls short.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, land, text_slices

SAMPLED = 4
REPETITIONS = 8
MAX_WINDOW = 16
#: Items of fewer words than three windows of this size have few windows, so that each is walked twice as often.
SMALL_WINDOW = 4
#: Items are taken in blocks of about so many characters; the index of one block is broadcast.
BLOCK_CHARS = 2 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_KNOWN = 200_000
#: Up to so many pairs of item and word have a flag each.
MAX_PAIRS = 1 << 22
Leak = tuple[int, int, int, int]


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case: runs of letters, digits and other non-ASCII characters."""
    return _WORD.findall(text.lower() if text.isascii() else text.decode("utf-8", "replace").lower().encode())


def size_class(length: int) -> tuple[int, int]:
    """Window size and text stride for an item of so many words."""
    size = 1
    while size < MAX_WINDOW and 2 * size + size - 1 <= length:
        size *= 2
    return size, max(1, size // 2)


class Walk:
    """The sampled steps of one repetition's walk over windows of one size.

    A walk moves on at every second step, so the first 3 / 2 W steps lie within a window of W words; only the rare
    walk that runs ahead reads a word or two behind it."""

    def __init__(self, size: int, repetition: int, seed: int):
        rng = np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, size, repetition])))
        steps = max(1, 3 * size // 2)
        self.sampled = np.sort(rng.choice(steps, min(SAMPLED, steps), replace=False)).tolist()
        self.looked_up = self.sampled[1:2] + self.sampled[-1:]
        self.odd = rng.integers(0, 1 << 63, steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.size = size

    def keys(self, words: np.ndarray, starts: np.ndarray) -> dict[int, np.ndarray]:
        """A key for the window at each start, by the step after which it is looked up: the key of the steps up to
        it. ``words`` has a zero behind each text, where the walk stays."""
        at, key, out = starts.copy(), np.zeros(len(starts), np.uint64), {}
        for j in range(self.sampled[-1] + 1):
            key = self._step(j, words, at, key)
            if j in self.looked_up:
                out[j] = key
        return out

    def windows(self, words: np.ndarray, starts: np.ndarray, marks: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The places in ``starts`` of those windows that have a marked key at every step that is looked up, and their
        last keys. Most windows leave half-way."""
        at, key, left = starts.copy(), np.zeros(len(starts), np.uint64), np.arange(len(starts))
        for j in range(self.sampled[-1] + 1):
            key = self._step(j, words, at, key)
            if j in self.looked_up:
                on = np.flatnonzero(_marked(marks[j], key))
                at, key, left = at[on], key[on], left[on]
        return left, key

    def _step(self, j: int, words: np.ndarray, at: np.ndarray, key: np.ndarray) -> np.ndarray:
        here = words.take(at, mode="clip")
        if j in self.sampled:
            key = (key ^ here) * _MIX
            key ^= key >> np.uint64(29)
        here *= self.odd[j]
        here >>= np.uint64(63)
        at += here.view(np.int64)
        return key


def _marks(keys: np.ndarray) -> np.ndarray:
    """A table by the upper bits of a key: a key that is not marked is not among ``keys``, a marked one may be."""
    bits = min(22, max(12, (16 * len(keys)).bit_length()))
    out = np.zeros(1 << bits, bool)
    out[keys >> np.uint64(64 - bits)] = True
    return out


def _marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return marks[(keys >> np.uint64(65 - len(marks).bit_length())).view(np.int64)]


class Hashes(dict):
    """Hashes of words, made when first asked for; a task starts afresh when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = (xxhash.xxh64_intdigest(word, 9) >> 1) | 1 if word else 0
        return found


def _flat(texts: list[list[bytes]], known: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words with a zero behind each text, and where each text begins."""
    if len(known) > _KNOWN:
        known.clear()
    words: list[bytes] = []
    for t in texts:
        words += t
        words.append(b"")
    begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
    hashes = np.fromiter(map(known.__getitem__, words), np.int64, len(words)).view(np.uint64)
    return hashes * _MIX, begins


def align(item: list, text: list) -> tuple[int, int, int]:
    """Least edits that turn the item into a run of the text, and that run's first and end place."""
    def ends(a, b):
        codes = {w: i for i, w in enumerate(dict.fromkeys(a + b))}
        column = np.array([codes[w] for w in b])
        steps, row = np.arange(len(b) + 1), np.zeros(len(b) + 1, np.int64)
        for w in a:
            new = row + 1
            new[1:] = np.minimum(new[1:], row[:-1] + (column != codes[w]))
            row = np.minimum.accumulate(new - steps) + steps
        return row
    row = ends(item, text)
    end = int(row.argmin())
    back = ends(item[::-1], text[:end][::-1])
    # Among starts of equal cost the one that makes the run most like the item in length.
    best = np.flatnonzero(back == row[end])
    span = int(best[np.abs(best - len(item)).argmin()]) if len(best) else 0
    return int(row[end]), end - span, end


class ItemIndex:
    """The keys of a block of items, and the verification of candidates."""

    def __init__(self, items: list[tuple[int | None, str | None]], similarity: float, repetitions: int, seed: int):
        self.ids, self.words, known = [], [], Hashes()
        for item, text in items:
            words = words_of((text or "").encode())
            if words:
                self.ids.append(item)
                self.words.append(words)
        self.counts = [Counter(w) for w in self.words]
        self.allowed = [int((1 - similarity) * len(w) + 1e-9) for w in self.words]
        flat, begins = _flat(self.words, known)
        self._index_words(flat, begins)
        self.tables = []
        for size, stride in sorted({size_class(len(w)) for w in self.words}):
            own = [i for i, w in enumerate(self.words) if size_class(len(w))[0] == size]
            item = np.concatenate([np.full(len(self.words[i]) - size + 1, i) for i in own])
            offset = np.concatenate([np.arange(len(self.words[i]) - size + 1) for i in own])
            for r in range(2 * repetitions if size <= SMALL_WINDOW else repetitions):
                walk = Walk(size, r, seed)
                by_step = walk.keys(flat, begins[item] + offset)
                keys = by_step[walk.sampled[-1]]
                order = np.argsort(keys, kind="stable")
                marks = {j: _marks(k) for j, k in by_step.items()}
                self.tables.append((walk, stride, marks, keys[order], item[order], offset[order]))

    def _index_words(self, flat: np.ndarray, begins: np.ndarray) -> None:
        """Which words belong to which item: sorted word hashes, and sorted (item, word) pairs."""
        self.vocabulary = np.unique(flat[flat > 0])
        item = np.repeat(np.arange(len(self.words)), np.diff(begins))[flat > 0]
        word = np.searchsorted(self.vocabulary, flat[flat > 0])
        self.owned = np.unique(item * (len(self.vocabulary) + 1) + word)
        self.lengths = np.diff(begins) - 1
        self.known = _marks(self.vocabulary)
        # A small index has a flag for every pair of item and word; a larger one searches the pairs.
        pairs = len(self.words) * (len(self.vocabulary) + 1)
        self.owns = np.isin(np.arange(pairs), self.owned) if pairs <= MAX_PAIRS else None

    def _codes(self, flat: np.ndarray) -> np.ndarray:
        """The place of each word in the vocabulary, or the size of the vocabulary for other words."""
        size = len(self.vocabulary)
        code = np.full(len(flat), size)
        maybe = np.flatnonzero(_marked(self.known, flat))
        place = np.searchsorted(self.vocabulary, flat[maybe])
        is_one = self.vocabulary[np.minimum(place, size - 1)] == flat[maybe]
        code[maybe[is_one]] = place[is_one]
        return code

    def _own(self, pair: np.ndarray) -> np.ndarray:
        if self.owns is not None:
            return self.owns[pair]
        return self.owned[np.minimum(np.searchsorted(self.owned, pair), len(self.owned) - 1)] == pair

    def _sharing(self, flat: np.ndarray, begins: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Those candidates around which the text has enough places with words of the item: a true match keeps
        all but the allowed edits of the item's words, each at a place of its own."""
        if not len(self.vocabulary) or not len(found):
            return found[:0]
        size = len(self.vocabulary)
        code = self._codes(flat)
        allowed = np.array(self.allowed)
        # Places with a word of any item bound those with a word of the item.
        shared = np.concatenate(([0], np.cumsum(code < size)))
        text, item, place = found.T
        slack, length = allowed[item], self.lengths[item]
        low = np.maximum(begins[text] + place - slack, begins[text])
        high = np.maximum(np.minimum(begins[text] + place + length + slack, begins[text + 1] - 1), low)
        found = found[shared[high] - shared[low] >= length - slack]
        keep = np.zeros(len(found), bool)
        many = max(1, min(4096, (1 << 20) // (int(self.lengths.max()) * 2)))
        for at in range(0, len(found), many):
            text, item, place = found[at:at + many].T
            slack, length = allowed[item], self.lengths[item]
            low = np.maximum(begins[text] + place - slack, begins[text])
            high = np.minimum(begins[text] + place + length + slack, begins[text + 1] - 1)
            count = np.maximum(high - low, 0)
            who = np.repeat(np.arange(len(text)), count)
            spot = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[who]
            pair = item[who] * (size + 1) + code[spot]
            hit = self._own(pair)
            keep[at:at + many] = np.bincount(who[hit], minlength=len(text)) >= length - slack
        return found[keep]

    def candidates(self, flat: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Rows (text, item, place of the item's start in the text) without repeats, in order."""
        found = []
        lengths = np.diff(begins) - 1
        starts_of: dict[int, tuple] = {}
        for walk, stride, marks, keys, item, offset in self.tables:
            if stride not in starts_of:
                counts = -(-lengths // stride)
                text = np.repeat(np.arange(len(lengths)), counts)
                inside = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * stride
                starts_of[stride] = text, inside
            text, inside = starts_of[stride]
            left, own = walk.windows(flat, begins[text] + inside, marks)
            low = np.searchsorted(keys, own, "left")
            many = np.searchsorted(keys, own, "right") - low
            if not many.any():
                continue
            window = np.repeat(left, many)
            entry = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
            found.append(np.stack((text[window], item[entry], inside[window] - offset[entry])))
        return self._distinct(np.concatenate(found, 1)) if found else np.zeros((0, 3), np.int64)

    def _distinct(self, found: np.ndarray) -> np.ndarray:
        """Columns (text, item, place) as rows without repeats, in order."""
        text, item, place = found
        first, spread = int(place.min()), int(np.ptp(place)) + 1
        if (int(text.max()) + 1) * len(self.words) * spread >= 1 << 63:
            return np.unique(found.T, axis=0)
        rest, place = np.divmod(np.unique((text * len(self.words) + item) * spread + (place - first)), spread)
        return np.stack((*np.divmod(rest, len(self.words)), place + first), 1)

    def leaks(self, texts: list[bytes], known: Hashes) -> list[list[Leak]]:
        """For each text: (item, edits, first word, end) of each item found in it, best place of each."""
        words = [words_of(t) for t in texts]
        flat, begins = _flat(words, known)
        best: list[dict[int, Leak]] = [{} for _ in texts]
        seen = set()
        for t, i, place in self._sharing(flat, begins, self.candidates(flat, begins)).tolist():
            item, slack = self.words[i], self.allowed[i]
            step = max(1, len(item) // 4)
            if (t, i, place // step) in seen:
                continue
            seen.add((t, i, place // step))
            low = max(0, place // step * step - slack)
            near = words[t][low:max(0, (place // step + 1) * step) + len(item) + slack]
            counts = self.counts[i]
            if sum(min(n, counts[w]) for w, n in Counter(near).items() if w in counts) < len(item) - slack:
                continue
            edits, first, end = align(item, near)
            if edits <= slack:
                leak = (i, edits, low + first, low + end)
                best[t][i] = min(best[t].get(i, leak), leak, key=lambda x: x[1:])
        return [[(self.ids[i], e, a, b) for i, e, a, b in (d[i] for i in sorted(d))] for d in best]


def indexes(items: DataFrame, id_col: str, text_col: str, similarity: float, repetitions: int,
            seed: int) -> tuple[int, Iterator[Broadcast]]:
    """The number of blocks of bounded size that hold the items, and their broadcast indexes, each made when it is asked for."""
    spark: SparkSession = items.sparkSession
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_CHARS))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))

    def made() -> Iterator[Broadcast]:
        for b in range(blocks):
            held = sorted(map(tuple, rows.where(block == b).distinct().collect()), key=lambda r: (r[0] is None, r))
            index = ItemIndex(held, similarity, repetitions, seed)
            if index.ids:
                yield spark.sparkContext.broadcast(index)
    return blocks, made()


def leaks_column(text: Column, index) -> Column:
    """An array of the leaks of one block of items in a text."""
    @F.arrow_udf("array<struct<item_id: bigint, edits: int, first_word: int, end_word: int>>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()),
                                   ("first_word", pa.int32()), ("end_word", pa.int32())]))
        names, known = [f.name for f in kind.value_type], Hashes()
        for texts in batches:
            for rows in text_slices(texts):
                found = index.value.leaks([t or b"" for t in rows], known)
                yield pa.array([[dict(zip(names, leak)) for leak in leaks] for leaks in found], kind)
    return find(text)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text", similarity: float = 0.8,
               repetitions: int = REPETITIONS, seed: int = 7) -> DataFrame:
    """One row per document row and item found in it: ``doc_id``, ``item_id``, ``edits`` (words), ``first_word``
    and ``end_word`` of the best place (fewest edits, then the first).

    An item is found where at most a share of 1 - ``similarity`` of its words has to be edited to make it a run
    of the text's words; case and punctuation do not count. Null, empty and wordless texts and items match
    nothing. Equal items under several ids are all reported; an item repeated with its id once. Repeated
    documents are reported as often as they occur, null ids as null. Long texts are searched whole. Only the
    named columns are read, and empty tables on either side give an empty result. Items of more than ``BLOCK_CHARS``
    characters are searched block by block; each block's leaks are landed and its index is freed before the next is made,
    so memory does not grow with the items, but the documents are read once for each block.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    blocks, made = indexes(items, item_id_col, item_text_col, similarity, repetitions, seed)
    parts = []
    for index in made:
        part = rows.select("doc_id", F.inline(leaks_column(F.col("text"), index)))
        if blocks > 1:
            part, _ = land(part, "leaks")
            index.destroy()
        parts.append(part)
    if not parts:
        return rows.select("doc_id", F.expr("inline(cast(array() as array<struct<item_id: bigint, edits: int, "
                                            "first_word: int, end_word: int>>))"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
               item_text_col: str = "text", similarity: float = 0.8, repetitions: int = REPETITIONS,
               seed: int = 7) -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no item is found.

    Items of more than ``BLOCK_CHARS`` characters are searched block by block; what each leaves is landed for the next."""
    blocks, made = indexes(items, item_id_col, item_text_col, similarity, repetitions, seed)
    out, path = docs, None
    for index in made:
        out = out.where(F.size(leaks_column(F.col(text_col), index)) == 0)
        if blocks > 1:
            before = path
            out, path = land(out, "without-leaks")
            index.destroy()
            if before:
                discard(docs.sparkSession, before)
    return out
