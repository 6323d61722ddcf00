import random

import numpy as np
import pytest

from fareloom.llm import decontam


def plain_distance(item, text):
    """Least edits that turn the item into some run of the text."""
    row = [0] * (len(text) + 1)
    for w in item:
        new = [row[0] + 1]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != x)))
        row = new
    return min(row)


def edited(rng, words, k, vocabulary):
    words = list(words)
    for _ in range(k):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        if kind == 0:
            words[at] = rng.choice(vocabulary)
        elif kind == 1:
            words.insert(at, rng.choice(vocabulary))
        elif len(words) > 1:
            del words[at]
    return words


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    vocabulary = ["the", "of", "and"] * 30 + ["".join(rng.choices("aeinorst", k=rng.randint(3, 9))) for _ in range(500)]
    items = [(100 + i, " ".join(rng.choices(vocabulary, k=rng.randint(12, 60)))) for i in range(30)]
    docs = []
    for d in range(300):
        words = rng.choices(vocabulary, k=rng.randint(0, 200))
        if d % 3 == 0:
            own = rng.choice(items)[1].split()
            k = rng.choice([0, 0, 0.05, 0.1, 0.2, 0.4])
            at = rng.randint(0, len(words))
            words[at:at] = edited(rng, own, int(k * len(own)), vocabulary)
        docs.append((d, " ".join(words).capitalize().replace(" the ", ", The ")))
    return items, docs


def brute(items, docs, similarity=0.8):
    out = {}
    for d, text in docs:
        words = decontam.words_of((text or "").encode())
        for i, t in items:
            item = decontam.words_of((t or "").encode())
            if item and words:
                edits = plain_distance(item, words)
                if edits <= (1 - similarity) * len(item) + 1e-9:
                    out[d, i] = edits
    return out


def test_recall_and_precision_against_brute_force(spark, corpus):
    items, docs = corpus
    want = brute(items, docs)
    found = decontam.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): r for r in found}
    assert len(got) == len(found)
    assert set(got) <= set(want) and len(got) >= 0.9 * len(want) and len(want) > 60
    assert all(got[k].edits >= e for k, e in want.items() if k in got)
    assert all(k in got and got[k].edits == 0 for k, e in want.items() if e == 0)
    by_doc, by_item = dict(docs), dict(items)
    for (d, i), r in got.items():
        span = decontam.words_of(by_doc[d].encode())[r.first_word:r.end_word]
        assert plain_distance(decontam.words_of(by_item[i].encode()), span) == r.edits


def test_blocks_of_items_give_the_same(spark, corpus, monkeypatch):
    items, docs = corpus
    frames = (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    one = sorted(map(tuple, decontam.find_leaks(*frames).collect()))
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 1500)
    assert sorted(map(tuple, decontam.find_leaks(*frames).collect())) == one
    clean = decontam.drop_leaks(*frames)
    assert sorted(r.doc_id for r in clean.collect()) == sorted({d for d, _ in docs} - {r[0] for r in one})


@pytest.mark.parametrize("length, passages", [(5, 300), (6, 100), (8, 100), (10, 100), (23, 60), (57, 40), (100, 30), (400, 12), (1000, 6)])
def test_recall_at_the_limit_does_not_fall_with_length(length, passages):
    rng = random.Random(length)
    vocabulary = ["".join(rng.choices("aeinorstlm", k=rng.randint(3, 9))) for _ in range(3000)]
    weights = [1 / (i + 2) for i in range(len(vocabulary))]
    found = 0
    for i in range(passages):
        item = rng.choices(vocabulary, weights, k=length)
        index = decontam.ItemIndex([(i, " ".join(item))], 0.8, decontam.REPETITIONS, 7)
        around = rng.choices(vocabulary, weights, k=80)
        text = around[:i] + edited(rng, item, length // 5, vocabulary) + around[i:]
        found += [leak[0] for leak in index.leaks([" ".join(text).encode()], decontam.Hashes())[0]] == [i]
    assert found >= 0.95 * passages


def test_alignment():
    assert decontam.align(list("abcd"), list("xxabcdyy")) == (0, 2, 6)
    assert decontam.align(list("abcd"), list("xxabdyy")) == (1, 2, 5)
    assert decontam.align(list("ab"), []) == (2, 0, 0)


def test_odd_rows(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve"
    docs = [(None, "x " + passage), (1, None), (1, ""), (2, "..."), (3, passage.upper()), (3, passage.upper()),
            (4, "word " * 60_000 + passage + " word" * 10), (5, "twelve eleven ten nine")]
    items = [(7, passage), (7, passage), (8, passage + "!"), (None, passage), (9, None), (10, ""), (11, "--"), (12, "solo")]
    found = decontam.find_leaks(spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int"),
                                spark.createDataFrame(items, "item_id long, text string"))
    got = sorted(((r.doc_id or 0, r.item_id or 0) for r in found.collect()))
    assert got == sorted((d, i) for d in (0, 3, 3, 4) for i in (7, 8, 0))
    long = found.where("doc_id = 4 and item_id = 7").first()
    assert (long.edits, long.first_word, long.end_word) == (0, 60_000, 60_012)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), none).collect() == []
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert decontam.find_leaks(empty, spark.createDataFrame(items, "item_id long, text string")).collect() == []


def test_one_index_at_a_time(spark, corpus, monkeypatch):
    """With several blocks, an index is destroyed before the next one is made."""
    items, docs = corpus
    frames = (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 3000)
    held, most = [], []
    broadcast, destroy = type(spark.sparkContext).broadcast, decontam.Broadcast.destroy

    def counted(context, value):
        made = broadcast(context, value)
        if isinstance(value, decontam.ItemIndex):
            held.append(made)
            most.append(len(held))
        return made

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", counted)
    monkeypatch.setattr(decontam.Broadcast, "destroy", lambda b: (held.remove(b), destroy(b)))
    clean = decontam.drop_leaks(*frames)
    assert len(most) > 1 and set(most) == {1} and held == []
    assert 0 < clean.count() < len(docs)


@pytest.mark.parametrize("pairs", [decontam.MAX_PAIRS, 0])
def test_most_windows_leave_early_and_no_candidate_is_lost(pairs, monkeypatch):
    """Windows without a marked key are dropped half-way; the candidates are those of looking up every window's key."""
    monkeypatch.setattr(decontam, "MAX_PAIRS", pairs)
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("aeinorstlm", k=rng.randint(3, 9))) for _ in range(2000)]
    items = [rng.choices(vocabulary, k=n) for n in (1, 2, 5, 12, 12, 30, 30, 90)]
    index = decontam.ItemIndex([(i, " ".join(item)) for i, item in enumerate(items)], 0.8, decontam.REPETITIONS, 7)
    texts = [rng.choices(vocabulary, k=200) + edited(rng, item, len(item) // 5, vocabulary) + rng.choices(vocabulary, k=50)
             for item in items]
    flat, begins = decontam._flat([[w.encode() for w in t] for t in texts], decontam.Hashes())
    want = set()
    for walk, stride, marks, keys, item, offset in index.tables:
        starts = np.concatenate([np.arange(a, b - 1, stride) for a, b in zip(begins, begins[1:])])
        own = walk.keys(flat, starts)[walk.sampled[-1]]
        left, last = walk.windows(flat, starts, marks)
        assert len(left) < 0.1 * len(starts) and (own[left] == last).all()
        for at, key in zip(starts.tolist(), own):
            text = int(np.searchsorted(begins, at, "right")) - 1
            want |= {(text, int(item[e]), at - int(begins[text]) - int(offset[e])) for e in np.flatnonzero(keys == key)}
    found = index.candidates(flat, begins)
    assert list(map(tuple, found.tolist())) == sorted(want)
    leaks = index.leaks([" ".join(t).encode() for t in texts], decontam.Hashes())
    assert all(i in {leak[0] for leak in of} for i, of in enumerate(leaks))
