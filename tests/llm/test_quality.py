import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from fareloom.llm import quality


def corpus(rng, n):
    words = ["".join(rng.choices("aeionrst", k=rng.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        good = i % 4 > 0
        text = " ".join(rng.choices(words, k=rng.randint(5, 60)))
        rows.append((i, text if good else text.upper().replace(" ", "!! "), int(good)))
    return rows


def test_learns_from_the_training_fold_only(spark):
    rows = corpus(random.Random(1), 300)
    fold = {i: zlib.crc32(str(i).encode()) % 5 != 0 for i, _, _ in rows}
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (5, None)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert all(got[i].held_out != fold[i] for i in got)
    assert all(got[i].predicted == q for i, _, q in rows)
    flipped = spark.createDataFrame([(i, q if fold[i] else 1 - q) for i, _, q in rows], "doc_id long, quality int")
    again = {r.doc_id: r.score for r in quality.classify(docs, flipped).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_scores_depend_on_the_text_alone(spark):
    rows = corpus(random.Random(2), 100)
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    learnt = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    weights = quality.train(learnt, labels)
    odd = [(None, "same words"), (1, "same words"), (1, "same words"), (2, None), (3, ""), (4, " \n"), (5, "many " * 100_000)]
    docs = spark.createDataFrame(odd, "doc_id long, text string")
    got = docs.select("text", quality.score_column(docs, weights, F.col("text")).alias("s")).collect()
    assert len({r.s for r in got if r.text == "same words"}) == 1
    assert len({r.s for r in got if not (r.text or "").strip()}) == 1
    assert all(0 < r.s < 1 for r in got)


def test_the_sample_is_bounded(spark):
    rows = corpus(random.Random(3), 400)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    got = quality.classify(docs, labels, max_rows=80).collect()
    assert sum(r.predicted == q for r, (_, _, q) in zip(sorted(got), rows)) > 380


def test_nothing_to_learn_or_to_score(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [(r.score, r.predicted) for r in quality.classify(docs, none).collect()] == [(0.5, 1)]
    assert quality.classify(docs.limit(0), none).collect() == []
    assert np.array_equal(quality.features(b"", {})[0], [])


def test_an_id_with_very_many_rows_is_learnt_once(spark):
    rows = corpus(random.Random(4), 120)
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    once = quality.train(spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"), labels)
    hot = next(i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5)
    again = [(i, t) for i, t, _ in rows] + [(hot, rows[hot][1])] * 500 + [(hot, "~ " + rows[hot][1]), (hot, None)]
    assert np.array_equal(quality.train(spark.createDataFrame(again, "doc_id long, text string"), labels), once)


def plain_features(text):
    """Shares of words, word pairs, shapes and shape pairs, by plain loops over whole numbers."""
    words = (text or "").encode().split()
    shapes, mask, out = [], (1 << 64) - 1, defaultdict(float)
    for k, w in enumerate(words):
        shape = re.sub(rb"[0-9]+", b"0", re.sub(rb"[A-Z]+", b"A", re.sub(rb"[a-z\x80-\xff]+", b"a", w)))
        shapes.append(b"=" if k and w.lower() == words[k - 1].lower() else shape)
    streams = ([xxhash.xxh64_intdigest(w.lower(), 0) for w in words], [xxhash.xxh64_intdigest(x, 1) for x in shapes])
    for hashes in streams:
        pairs = [((a * 0x9E3779B97F4A7C15 & mask) ^ b) * 0x9E3779B97F4A7C15 & mask for a, b in zip(hashes, hashes[1:])]
        for grams in (hashes, pairs):
            for g in grams:
                out[g >> 64 - quality.BITS] += 1 / len(grams)
    return {k: float(np.float32(v)) for k, v in out.items()}


def plain_scores(rows, labels, draws, epochs=3, alpha=0.5, beta=1.0, l1=0.02, l2=0.1):
    """Follow the regularised leader over dictionaries, one coordinate at a time."""
    z, n, constant = defaultdict(float), defaultdict(float), -1

    def weight(k):
        if abs(z[k]) <= l1:
            return 0.0
        return -(z[k] - math.copysign(l1, z[k])) / ((beta + math.sqrt(n[k])) / alpha + l2)

    def chance(x):
        return 1 / (1 + math.exp(-min(max(sum(weight(k) * v for k, v in x.items()), -35), 35)))
    known = [(draws[i], labels[i], plain_features(t) | {constant: 1.0}) for i, t in rows
             if i in labels and zlib.crc32(str(i).encode()) % 5]
    for epoch in range(epochs):
        for _, label, x in sorted(known, key=lambda r: r[0] * (2 * epoch + 1) % (1 << 40)):
            p = chance(x)
            for k, v in x.items():
                g, w = (p - label) * v, weight(k)
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / alpha * w
                n[k] += g * g
    return {i: chance(plain_features(t) | {constant: 1.0}) for i, t in rows}


def test_scores_equal_a_plain_learner(spark):
    """The registered query on the whole of the smallest tables."""
    from fareloom.llm.queries import QUERIES
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r.quality is not None}
    draws = dict(map(tuple, docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 40))).collect()))
    want = plain_scores(rows, labels, draws)
    got = {r.doc_id: r.score for r in QUERIES["op7_quality_classifier"](spark, sf_dir).collect()}
    assert got.keys() == want.keys() and len(labels) > 30
    assert max(abs(got[i] - want[i]) for i in want) < 1e-4
