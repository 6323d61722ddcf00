"""BPE encoding and decoding by speculation: propose, verify, and merge exactly only what failed.

The words of a batch that are not known yet are encoded together. Greedy longest match over a trie of the
vocabulary proposes tokens for all of them in step. A proposal is the BPE result exactly if every two adjacent
tokens are compatible: undoing the merges of both from the last one back, no merge across their border may
come earlier than the one undone. That test runs vectorised over all distinct adjacent pairs. Words with an
incompatible pair go through the merges in rank order, again all words in step.

Texts never meet in a group and nothing is shuffled; a task holds slices of a few megabytes of text and a
bounded table of known words.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_slices

#: A tokenizer file is broadcast; larger ones are refused.
MAX_FILE_BYTES = 64 << 20
#: So many encoded words are remembered by a task before it starts afresh.
KNOWN_WORDS = 100_000
#: Longer words (in bytes) are merged one by one with a queue, in n log n steps.
LONG_WORD = 256
_NONE = np.int64(1 << 40)


class Pairs:
    """A fixed map from pairs of small integers to integers, looked up for whole arrays."""

    def __init__(self, left, right, values):
        keys = self._key(np.asarray(left, np.int64), np.asarray(right, np.int64))
        bits = max(4, int(4 * len(keys) + 1).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys, self._values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int64)
        values, todo, self._probes = np.asarray(values, np.int64), np.arange(len(keys)), 0
        slots = self._slot(keys)
        while len(todo):
            at = (slots[todo] + self._probes) & self._mask
            free, first = np.unique(np.where(self._keys[at] < 0, at, -1), return_index=True)
            took = first[free >= 0]
            self._keys[at[took]], self._values[at[took]] = keys[todo[took]], values[todo[took]]
            todo, self._probes = np.delete(todo, took), self._probes + 1

    @staticmethod
    def _key(left, right):
        return left << 31 | right

    def _slot(self, keys):
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self._shift).astype(np.int64)

    def get(self, left, right):
        keys = self._key(left, right)
        at, out = self._slot(keys), np.full(len(keys), _NONE, np.int64)
        open_ = np.arange(len(keys))
        for probe in range(self._probes):
            slot = (at[open_] + probe) & self._mask
            held = self._keys[slot]
            hit = held == keys[open_]
            out[open_[hit]] = self._values[slot[hit]]
            open_ = open_[~hit & (held >= 0)]
            if not len(open_):
                break
        return out


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in vocabulary files: itself for the visible Latin-1
    characters, and the next unused code point from 256 on for the rest."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Model:
    """A BPE model with word ends, as its JSON file describes it."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        end = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or not end or model.get("unk_token") or model.get("byte_fallback") \
                or model.get("dropout") or model.get("continuing_subword_prefix") or spec.get("decoder"):
            raise ValueError("a byte-level BPE file with word ends and without decoder is expected")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or not split["invert"] or split["behavior"] != "Removed":
            raise ValueError("normalisation to NFC, blanks and lower case and a pattern of words are expected")
        vocab, alphabet = model["vocab"], byte_alphabet()
        self.names = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self._words = regex.compile(split["pattern"]["Regex"])
        # Symbols: bytes inside a word, and bytes at its end.
        self.base = np.array([vocab[c] for c in alphabet] + [vocab[c + end] for c in alphabet], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([vocab[m[k]] for m in merges], np.int64) for k in (0, 1))
        made = np.array([vocab["".join(m)] for m in merges], np.int64)
        if len(set(made.tolist())) != len(made):
            raise ValueError("two merges make the same token")
        size = max(vocab.values()) + 1
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        self.rank[made], self.left[made], self.right[made] = np.arange(len(made)), left, right
        self.made, self.merge = made, Pairs(left, right, np.arange(len(made)))
        symbol = {c: b for b, c in enumerate(alphabet)}
        spelt = {i: [symbol[c] for c in t[:-len(end)]] if t.endswith(end) and len(t) > len(end) else [symbol[c] for c in t]
                 for t, i in vocab.items()}
        for t, i in vocab.items():
            if t.endswith(end) and len(t) > len(end):
                spelt[i][-1] += 256
        self._plant(spelt)

    def _plant(self, spelt: dict[int, list[int]]) -> None:
        """The trie of those tokens that BPE makes of their own spelling; others can be in no result."""
        ids = list(spelt)
        flat, starts = _flat([self.base[spelt[i]] for i in ids])
        tokens, at = self._merge_all(flat, starts)
        own = [i for k, i in enumerate(ids) if at[k + 1] - at[k] == 1 and tokens[at[k]] == i]
        edges, ends = {}, {}
        for i in own:
            node = 0
            for s in spelt[i]:
                node = edges.setdefault((node, s), len(edges) + 1)
            ends[node] = i
        self.trie = Pairs([a for a, _ in edges], [s for _, s in edges], list(edges.values()))
        self.token_at = np.full(len(edges) + 1, -1, np.int64)
        self.token_at[list(ends)] = list(ends.values())

    # -- proposals -----------------------------------------------------------------------------------

    def _propose(self, symbols, starts):
        """Greedy longest matches of all words in step: tokens, and where each word's begin."""
        words = len(starts) - 1
        live, stop = np.arange(words), starts[1:]
        at = starts[:-1].copy()          # next symbol to look at
        node, token, after = np.zeros(words, np.int64), np.full(words, -1, np.int64), at.copy()
        who, what = [], []
        while len(live):
            inside = at[live] < stop[live]
            step = np.full(len(live), _NONE)
            step[inside] = self.trie.get(node[live[inside]], symbols[at[live[inside]]])
            moved = step < _NONE
            go = live[moved]
            node[go] = step[moved]
            at[go] += 1
            named = self.token_at[node[go]]
            hit = named >= 0
            token[go[hit]], after[go[hit]] = named[hit], at[go[hit]]
            stuck = live[~moved]
            who.append(stuck)
            what.append(token[stuck])
            node[stuck], at[stuck], token[stuck] = 0, after[stuck], -1
            live = np.concatenate((go, stuck[after[stuck] < stop[stuck]]))
        who, what = np.concatenate(who), np.concatenate(what)
        order = np.argsort(who, kind="stable")
        counts = np.bincount(who, minlength=words)
        return what[order], np.concatenate(([0], np.cumsum(counts)))

    # -- verification --------------------------------------------------------------------------------

    def compatible(self, left, right):
        """Whether BPE keeps each pair of tokens apart when they stand side by side."""
        good = np.ones(len(left), bool)
        live = np.arange(len(left))
        left, right = left.copy(), right.copy()
        limit = np.full(len(left), _NONE - 1)  # a merge across the border of this rank or less comes first
        while len(live):
            l, r = left[live], right[live]
            across = self.merge.get(l, r)
            bad = across <= limit[live]
            good[live[bad]] = False
            undo_left = self.rank[l] > self.rank[r]
            base = (self.rank[l] < 0) & (self.rank[r] < 0)
            limit[live] = np.where(undo_left, self.rank[l] - 1, self.rank[r])  # equal ranks: the left one first
            left[live], right[live] = np.where(undo_left, self.right[l], l), np.where(undo_left, r, self.left[r])
            live = live[~bad & ~base]
        return good

    # -- exact merging -------------------------------------------------------------------------------

    def _merge_all(self, tokens, starts):
        """All words through the merges in rank order, the leftmost first among equals."""
        words = len(starts) - 1
        word = np.repeat(np.arange(words), np.diff(starts))
        done_word, done_token = [], []
        while len(tokens):
            rank = np.full(len(tokens), _NONE)
            same = np.flatnonzero(word[:-1] == word[1:])
            rank[same] = self.merge.get(tokens[same], tokens[same + 1])
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(tokens))))
            over = least >= _NONE
            done_word.append(word[over])
            done_token.append(tokens[over])
            best = np.flatnonzero((rank == least) & ~over)
            best = best[np.concatenate(([True], word[best][1:] != word[best][:-1]))] if len(best) else best
            tokens = tokens.copy()
            tokens[best] = self.made[rank[best]]
            keep = ~over
            keep[best + 1] = False
            tokens, word = tokens[keep], word[keep]
        word = np.concatenate(done_word) if done_word else np.zeros(0, np.int64)
        token = np.concatenate(done_token) if done_token else np.zeros(0, np.int64)
        order = np.argsort(word, kind="stable")
        return token[order], np.concatenate(([0], np.cumsum(np.bincount(word, minlength=words))))

    def _merge_long(self, tokens):
        """One long word, with a queue of its mergeable pairs."""
        tokens, n = tokens.tolist(), len(tokens)
        after, before = list(range(1, n)) + [-1], [-1, *range(n - 1)]
        ranks = self.merge.get(np.array(tokens[:-1], np.int64), np.array(tokens[1:], np.int64)).tolist()
        queue = [(r, i, tokens[i], tokens[i + 1]) for i, r in enumerate(ranks) if r < _NONE]
        heapq.heapify(queue)
        while queue:
            rank, i, a, b = heapq.heappop(queue)
            j = after[i]
            if tokens[i] != a or j < 0 or tokens[j] != b:
                continue
            tokens[i], tokens[j], after[i] = int(self.made[rank]), -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0:
                    r = int(self.merge.get(np.array([tokens[x]]), np.array([tokens[y]]))[0])
                    if r < _NONE:
                        heapq.heappush(queue, (r, x, tokens[x], tokens[y]))
        return np.array([t for t in tokens if t >= 0], np.int64)

    # -- words and texts -----------------------------------------------------------------------------

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each (non-empty) word, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        short = []
        for k, w in enumerate(words):
            if len(w) > LONG_WORD:
                symbols = np.frombuffer(w, np.uint8).astype(np.int64)
                symbols[-1] += 256
                out[k] = self._merge_long(self.base[symbols]).astype("<u4").tobytes()
            else:
                short.append(k)
        if not short:
            return out
        symbols, starts = _flat([np.frombuffer(words[k], np.uint8) for k in short])
        symbols = symbols.astype(np.int64)
        symbols[starts[1:] - 1] += 256
        tokens, at = self._propose(symbols, starts)
        word = np.repeat(np.arange(len(short)), np.diff(at))
        inner = np.flatnonzero(word[:-1] == word[1:])
        pairs, of = np.unique(tokens[inner] << 31 | tokens[inner + 1], return_inverse=True)
        fits = self.compatible(pairs >> 31, pairs & (1 << 31) - 1)
        failed = np.unique(word[inner[~fits[of]]])
        found, cut = tokens.astype("<u4").tobytes(), (4 * at).tolist()
        for k, a, b in zip(short, cut, cut[1:]):
            out[k] = found[a:b]
        if len(failed):
            lengths = np.diff(starts)[failed]
            begins = np.concatenate(([0], np.cumsum(lengths)))
            picked = np.repeat(starts[failed] - begins[:-1], lengths) + np.arange(begins[-1])
            tokens, at = self._merge_all(self.base[symbols[picked]], begins)
            found, cut = tokens.astype("<u4").tobytes(), (4 * at).tolist()
            for k, a, b in zip(failed.tolist(), cut, cut[1:]):
                out[short[k]] = found[a:b]
        return out

    def pieces(self, text: str) -> list[str]:
        """Words and special tokens of a text. Characters are lowered one by one: a last sigma stays one.

        Code points that Unicode assigned after version 16 are letters or not as the pattern library knows them.
        """
        out = []
        for part in self._special.split(text) if self._special else [text]:
            if part in self.special:
                out.append(part)
            elif part:
                if not part.isascii():
                    part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
                out += self._words.findall(part.lower())
        return out

    def encode(self, texts: list[bytes], known: dict[str, bytes]) -> list[bytes]:
        split = [self.pieces(t.decode("utf-8", "replace")) for t in texts]
        new = {p for pieces in split for p in pieces}
        new.difference_update(known)
        if len(known) + len(new) > KNOWN_WORDS:
            known.clear()
            new = {p for pieces in split for p in pieces}
        known |= self.special
        new = [p for p in new if p not in self.special]
        known.update(zip(new, self.encode_words([p.encode("utf-8") for p in new])))
        return [b"".join(map(known.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> str:
        """The token texts with a blank between them; ids outside the vocabulary are left out."""
        return " ".join(filter(None, map(self.names.get, np.frombuffer(ids, "<u4").tolist())))


def _flat(parts):
    starts = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), starts


_MODELS: dict[str, Model] = {}


def _model(content: Broadcast) -> Model:
    """The model of a broadcast file, built once in each Python worker."""
    if content.value not in _MODELS:
        _MODELS.clear()
        _MODELS[content.value] = Model(content.value)
    return _MODELS[content.value]


def load(spark: SparkSession, path: str) -> Broadcast:
    """Reads a tokenizer file in the driver and broadcasts its text (at most ``MAX_FILE_BYTES``)."""
    with open(path, encoding="utf-8") as f:
        content = f.read(MAX_FILE_BYTES + 1)
    if len(content) > MAX_FILE_BYTES:
        raise ValueError(f"{path} holds more than {MAX_FILE_BYTES} bytes")
    Model(content)  # refuse an unfit file here rather than in the tasks
    return spark.sparkContext.broadcast(content)


def encode_column(text: Column, tokenizer: Broadcast) -> Column:
    """The ids of a text as binary: little-endian unsigned 32-bit integers."""
    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, known = _model(tokenizer), {}
        for texts in batches:
            for rows in text_slices(texts):
                yield pa.array(model.encode([t or b"" for t in rows], known), pa.binary())
    return encode(text)


def decode_column(ids: Column, tokenizer: Broadcast) -> Column:
    """The text of binary ids."""
    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _model(tokenizer)
        for batch in batches:
            for rows in text_slices(batch):
                yield pa.array([model.decode(i or b"") for i in rows], pa.string())
    return decode(ids)


def round_trip_column(text: Column, tokenizer: Broadcast) -> Column:
    """Ids and the text they decode to, by one Python worker instead of two."""
    @F.arrow_udf("struct<ids: binary, decoded: string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, known = _model(tokenizer), {}
        for texts in batches:
            for rows in text_slices(texts):
                ids = model.encode([t or b"" for t in rows], known)
                yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()),
                                                  pa.array(map(model.decode, ids), pa.string())], ["ids", "decoded"])
    return both(text)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False,
           keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the columns ``keep``, ``ids`` (binary), ``n_tokens``; with
    ``decoded`` also ``decoded``.

    Ids are those of the tokenizer file at ``path``, without added special tokens; the strings of special
    tokens inside a text give their ids. Null and empty texts give no ids and the empty text. Texts of any
    length are encoded whole. Repeated rows, null ids, empty tables and further columns need no care: each
    row is encoded by itself and only id and text are read.
    """
    tokenizer, text = load(docs.sparkSession, path), F.col(text_col)
    if decoded:
        out = docs.select(F.col(id_col).alias("doc_id"), *keep, round_trip_column(text, tokenizer).alias("trip"))
        out = out.select("doc_id", *keep, "trip.ids", "trip.decoded")
    else:
        out = docs.select(F.col(id_col).alias("doc_id"), *keep, encode_column(text, tokenizer).alias("ids"))
    return out.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))
