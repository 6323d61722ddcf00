import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k, asks):
    seen = []
    for i, v, *_ in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        seen.append((i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    asked = {}
    for i, q in seen:
        if asks(i):
            raw = np.array(q, "<i8").tobytes()
            if i not in asked or raw < np.array(asked[i], "<i8").tobytes():
                asked[i] = q
    out = []
    for i, q in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in seen if j != i and len(c) == len(q))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows,slice_queries", [(1 << 14, 1 << 16), (40, 7)])
def test_like_brute_force(spark, shard_rows, slice_queries):
    rng = random.Random(shard_rows)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(16)], "clash") for i in range(300)]
    rows += [(300 + i, [0.5] * 16, None) for i in range(100)]  # a hot vector, all ties
    rows += [(7, [0.5] * 16, None), (10, [rng.gauss(0, 1) for _ in range(16)], None), rows[20], rows[20]]
    rows += [(None, [1.0] * 16, None), (1000, None, None), (1010, [], None), (1020, [1.0, None], None),
             (1030, [float("nan")] * 16, None), (1040, [float("inf")] * 16, None), (1050, [1.0, -1.0], None),
             (1051, [2.0, 0.0], None), (1060, [1.0, 2.0, 3.0], None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, 5, shard_rows=shard_rows, slice_queries=slice_queries)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, lambda i: i % 10 == 0)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**20 + i), float(-(2**19) - 3 * i), 1.0 / 1024]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = []
    for i in (0, 20, 40):
        q = [math.floor(1024 * x) for x in rows[i][1]]
        scored = sorted((-sum(a * math.floor(1024 * x) for a, x in zip(q, v)), j) for j, v in rows if j != i)
        want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:4])]
    assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 20 == 0, 4).collect())) == want


def test_a_good_first_threshold_prunes(monkeypatch):
    """With clustered rows, a known k-th score lets the search skip most leaves."""
    rng = np.random.default_rng(1)
    x = np.floor(1024 * (rng.normal(0, 0.02, (4096, 8)) + rng.choice([-1, 1], (4096, 8)))).astype(np.int64)
    tree = topk.Tree(np.arange(4096), x)
    leaves = []
    monkeypatch.setattr(topk.np, "flatnonzero", lambda a: leaves.append(1) or np.nonzero(a)[0])
    best = tree.top(-1, x[0], tree.bounds(x[:1])[0].tolist(), 10, None)
    want = sorted(((int(x[i] @ x[0]), -i) for i in range(4096)), reverse=True)[:10]
    assert best == [(s, -i) for s, i in want]
    assert len(leaves) < 20


def test_nothing_to_search(spark):
    df = spark.createDataFrame([(1, [1.0], None), (2, [2.0], None)], SCHEMA)
    assert topk.top_k(df, F.col("vec_id") % 100 == 0).collect() == []
    assert topk.top_k(df.limit(0), F.lit(True)).collect() == []
    assert [tuple(r) for r in topk.top_k(df, F.col("vec_id") == 1).collect()] == [(1, 1, 2, 1024 * 2048)]


def test_a_component_beyond_all_scores_is_an_error(spark):
    rows = spark.createDataFrame([(1, [1.0]), (100, [3e38])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="too large for integer scores"):
        rows.select(topk.quantised(F.col("embedding"))).collect()
