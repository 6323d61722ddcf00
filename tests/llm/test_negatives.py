import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score string, dim int"


def plain(data, anchor, positives=5, keep=3):
    ok = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in data
          if i is not None and l is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    own = {}
    for i, v, l in ok:
        if anchor(i):
            own[i] = min(own.get(i, (np.array(v, "<f8").tobytes(), l, v)), (np.array(v, "<f8").tobytes(), l, v))
    out = []
    for a, (_, l, v) in own.items():
        scored = [(-sum(x * y for x, y in zip(v, w)), i, m == l) for i, w, m in ok if i != a and len(w) == len(v)]
        for s, p, _ in sorted(r for r in scored if r[2])[:positives]:
            inside = sorted((t, i) for t, i, same in scored if not same and 50 * -s <= 100 * -t <= 95 * -s)[:keep]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(inside)]
    return sorted(out, key=repr)


def mined(spark, data, **options):
    df = spark.createDataFrame([(*r, "x", 3) for r in data], SCHEMA)
    return negatives.hard_negatives(df, F.col("vec_id") % 5 == 0, **options)


def vectors(seed, n=220, dims=20):
    draw = np.random.default_rng(seed)
    centre = draw.normal(size=(3, dims))
    return [(i, [float(x) for x in centre[i % 3] * 0.8 + draw.normal(size=dims)], int(draw.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("seed", [3, 4])
def test_as_a_plain_search_over_many_shards_and_slices(spark, rows, seed):
    data = vectors(seed)
    data += [(i, data[7][1], 1) for i in range(300, 330)]  # ties
    data += data[10:14] + [(500, [1.0] * 8, 0), (505, [1.0] * 8, 0), (506, [0.9] * 8, 1)]  # repeated rows, another size
    data += [(None, data[0][1], 0), (600, None, 0), (605, [], 0), (610, [float("nan")] * 20, 0), (615, [None] * 20, 1), (620, data[1][1], None)]
    found = mined(spark, data, shard_rows=40, slice_anchors=16)
    assert rows(found) == plain(data, lambda i: i % 5 == 0)
    assert found.count() > 100


def test_zero_negative_and_huge_scores(spark, rows):
    data = [(0, [0.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 1.0], 1), (5, [1.0, 1.0], 0), (6, [-1.0, -1.0], 0), (7, [-3.0, 1.0], 1)]
    assert rows(mined(spark, data)) == plain(data, lambda i: i % 5 == 0)
    # Products beyond the whole numbers of a double are still exact; the vectors differ in their last digits only.
    huge = [(i, [float((1 << 20) + i % 3), float(i % 4), 1024.0], i % 2) for i in range(40)]
    big = [(i, [x * 2.0 ** 8 if j == 0 else x for j, x in enumerate(v)], l) for i, v, l in huge]
    big += [(100 + i, [2.0 ** 18 + i * 2.0 ** 4, 1.0 + i, 2.0], 1) for i in range(10)]
    assert rows(mined(spark, big, shard_rows=12)) == plain(big, lambda i: i % 5 == 0)


def test_what_cannot_be_scored(spark):
    assert mined(spark, []).count() == 0
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 1)]).count() == 0  # no anchor
    with pytest.raises(Exception, match="too large"):
        mined(spark, [(5, [1.7e308], 0)])


def test_lists_leave_out_what_cannot_reach_the_threshold():
    draw = np.random.default_rng(0)
    x = np.floor(draw.normal(size=(500, 64)) * 40)
    x[250:] = np.floor(x[250:] * 0.1)
    shard = negatives.Shard(np.arange(500), np.zeros(500, int), x)
    q = x[:20][:, shard.dims]
    least = np.full(20, 0.5 * float((q * q).sum(1).max()))
    at, row, score = shard.join(q, np.arange(20), np.zeros(20, int), least, True)
    want = {(i, j) for i in range(20) for j in range(500) if i != j and x[i] @ x[j] >= least[i]}
    assert set(zip(at.tolist(), row.tolist())) == want
    assert all(x[i] @ x[j] == s for i, j, s in zip(at, row, score))


def test_windows_of_a_random_order_do_not_matter(spark, rows):
    data = vectors(9, 80)
    random.Random(1).shuffle(data)
    assert rows(mined(spark, data)) == plain(data, lambda i: i % 5 == 0)
