import random

import pytest
import xxhash
from pyspark.sql import functions as F

from fareloom.llm import neardup
from fareloom.llm.fingerprints import simhash


@pytest.fixture()
def frame(spark):
    """A frame of documents from (doc_id, text) pairs."""
    return lambda rows, schema="doc_id long, text string": spark.createDataFrame(rows, schema)


def plain_simhash(text, k):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64(g.encode(), 42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, bits):
    """Smallest index reachable over at most ``bits`` differing bits."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, p in enumerate(prints):
        for j in range(i):
            if (p ^ prints[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", ["", "one", "Two words", "a b c d", "A\tb\n c\x0bd  e", "é\xa0ü x y z Z", "a " * 300])
def test_fingerprint_is_the_plain_one(text):
    assert simhash(text.encode(), 4) == plain_simhash(text, 4)


@pytest.mark.parametrize("bits,crowd", [(4, 64), (4, 2), (2, 64), (2, 2), (0, 64)])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, bits, crowd):
    monkeypatch.setattr(neardup, "CROWD", crowd)
    rng = random.Random(bits * 100 + crowd)
    prints = [0, (1 << 64) - 1]
    for _ in range(12):
        base = rng.getrandbits(64)
        prints += [base] + [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 7))) for _ in range(12)]
    prints = sorted(set(prints))
    links = neardup.fingerprint_links(spark.createDataFrame([(signed(p),) for p in prints], "fp long"), bits)
    found = links.collect()
    groups = {r.node: r.component for r in neardup.components(links).collect()}
    by_class = {}
    for p, c in zip(prints, classes(prints, bits)):
        by_class.setdefault(c, set()).add(signed(p))
    got = {}
    for p in prints:
        got.setdefault(groups.get(signed(p), signed(p)), set()).add(signed(p))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, by_class.values()))
    assert all((r.a ^ r.b) & ((1 << 64) - 1) for r in found)


def test_documents_get_the_smallest_reachable_id(spark, frame):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    rows = [(100, None), (7, ""), (8, " \n"), (None, None), (3, "x " * 5000), (4, "x " * 6000)]
    for i in range(10, 70):
        if i % 3 and rng.random() < 0.6:
            text = rows[-1][1].split()
            text[rng.randrange(len(text))] = "edited"
            rows.append((i, " ".join(text)))
        else:
            rows.append((i, " ".join(rng.choices(words, k=200))))
    rows += [rows[-1], rows[-2], (None, "lonely words without an id")]
    docs = frame(rows).withColumns({"component_id": F.lit("clash"), "fp": F.lit(1.5), "point": F.lit(None).cast("int")})
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id or -1)
                 for r in neardup.near_duplicates(docs, shingle=4).collect())
    prints = [plain_simhash(t or "", 4) for _, t in rows]
    of = classes(prints, 4)
    least = {}
    for c, (i, _) in zip(of, rows):
        least[c] = min([x for x in (least.get(c), i) if x is not None], default=None)
    want = sorted((i is None, i or 0, signed(p), least[c] if least[c] is not None else -1)
                  for (i, _), p, c in zip(rows, prints, of))
    assert got == want


def test_an_empty_table_has_an_empty_result(frame):
    assert neardup.near_duplicates(frame([])).collect() == []
