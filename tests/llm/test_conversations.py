import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fareloom.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, place int, part string, key1 double"


def plain_trie(turns, ids):
    """``turns``: per conversation a list of (role, text), for every member."""
    members, ends, size = defaultdict(list), defaultdict(list), {}
    for c in sorted(ids):
        path = tuple(turns.get(c, ()))
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            size[path[:d]] = len(path[d - 1][1].encode()) if d else 0
        ends[path].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out, total = [], {}
    for p in sorted(members, key=len, reverse=True):
        leaves = sum(total[k][0] for k in kids[p]) or 1
        saved = sum(total[k][1] for k in kids[p]) + (len(members[p]) - 1) * size[p]
        total[p] = leaves, saved
        out.append((members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(kids[p]), leaves, saved,
                    hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()))
    return sorted(out, key=repr)


def ordered(data):
    turns = defaultdict(list)
    for c, t, r, x, *_ in data:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(rows, key=lambda a: (a[0], a[1], a[2].encode(), a[3].encode()))] for c, rows in turns.items()}


def trie(spark, data, extra=()):
    df = spark.createDataFrame([(*r, 1, "p", 0.5) for r in data], SCHEMA)
    members = df.select("conv_id").union(spark.createDataFrame([(c,) for c in extra], "conv_id long"))
    return conversations.prefix_trie(conversations.place_turns(df), members)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_is_that_of_a_plain_version(spark, rows, seed):
    draw = random.Random(seed)
    data = []
    for c in range(60):
        for t in range(draw.randrange(1, 7)):
            data.append((c * 7 - 100, draw.choice([None, t, t, 2]), draw.choice(["user", None, ""]), draw.choice(["a", "bé", "", None])))
    data += [(400, t, "user", str(t)) for t in range(150)]  # a long chain that spans ranges
    data += [(401, t, "user", str(t)) for t in range(70)] + [(None, 0, "user", "x")] + data[:5]
    found = trie(spark, data, extra=[9999, -9999, None, 400])
    turns = ordered(data)
    assert rows(found) == plain_trie(turns, {*turns, 9999, -9999})


def test_copies_empty_tables_and_long_texts(spark, rows):
    data = [(c, t, "user", "x" * (200_000 if t == 1 else 3)) for c in range(-600, 600) for t in range(2)]
    turns = ordered(data)
    assert rows(trie(spark, data)) == plain_trie(turns, set(turns))
    assert trie(spark, []).count() == 0


def test_chains_halve_in_each_round(spark, monkeypatch):
    rounds = []
    real = conversations.land
    monkeypatch.setattr(conversations, "land", lambda df, label: (rounds.append(label), real(df, label))[1])
    nodes = spark.range(0, 257).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("depth"),
                                       F.when(F.col("id") > 0, 1).cast("long").alias("parent_conv_id"), F.lit(1).cast("long").alias("n"))
    totals = {r.depth: r.n for r in conversations._contract(nodes, ["n"]).collect()}
    assert totals == {d: 257 - d for d in range(257)}
    assert rounds.count("trie-round") <= 11


def test_turns_are_numbered_across_ranges(spark):
    data = [(7, t // 3, "r", str(t % 3)) for t in range(300)] + [(c, 0, "r", "") for c in range(20)]
    placed = conversations.place_turns(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"))
    assert sorted(r.place for r in placed.where("conv_id = 7").collect()) == list(range(1, 302))
