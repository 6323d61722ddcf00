import time
from collections import Counter

import numpy as np
import pytest

from fareloom.llm import sharding


def test_matrix_has_both_margins_and_every_task_sees_the_same():
    ends, cells = np.cumsum([5, 0, 17, 9, 1, 30]), np.array([20, 21, 1, 20, 0])
    rows = [sharding.matrix_row(7, ends, cells, b) for b in range(6)]
    assert np.sum(rows, axis=0).tolist() == cells.tolist()
    assert [int(r.sum()) for r in rows] == [5, 0, 17, 9, 1, 30]
    assert sharding.matrix_row(7, ends, cells, 2).tolist() == rows[2].tolist()


def test_large_populations_have_the_right_law(monkeypatch):
    """The own sampler against the library's on numbers that both take."""
    for good, bad, sample in ((4000, 6000, 2500), (9000, 1000, 300), (50, 9950, 9000), (5, 5, 10), (7, 0, 3)):
        rng = sharding._generator(1)
        monkeypatch.setattr(sharding, "_EXACT", 0)
        own = np.array([sharding.hypergeometric(rng, good, bad, sample) for _ in range(4000)])
        monkeypatch.setattr(sharding, "_EXACT", 10**9)
        mean, n = sample * good / (good + bad), good + bad
        sd = (mean * bad / n * (n - sample) / max(1, n - 1)) ** 0.5
        assert abs(own.mean() - mean) <= 5 * sd / 4000**0.5 + 1e-9
        assert abs(own.std() - sd) <= 0.1 * sd + 1e-9
    big = sharding.multivariate(sharding._generator(2), np.array([2 * 10**9, 10**9, 0, 3]), 10**9)
    assert big.sum() == 10**9 and abs(int(big[0]) - 666_666_666) < 10**5 and big[2] == 0


@pytest.mark.parametrize("cell_rows", [3, 1000])
def test_rows_are_kept_and_slots_have_no_gaps(spark, cell_rows):
    rows = [(i % 7 or None, "same" if i % 3 else None, i) for i in range(101)] + [(1, "x" * 100_000, 1)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, slot int").repartition(5)
    out = sharding.shuffle_into_shards(df, 4, seed=3, cell_rows=cell_rows)
    assert out.columns == ["doc_id", "text", "shard", "slot"]
    got = out.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((a, b) for a, b, _ in rows)
    assert sorted((r.shard, r.slot) for r in got) == [(s, k) for s in range(4) for k in range(26)]


def test_every_place_is_equally_likely(spark):
    """400 draws of 24 rows from 3 blocks into 2 shards: each row's place is spread evenly."""
    ends, cells = np.array([4, 14, 24]), np.array([6, 6, 6, 6])
    counts = np.zeros((3, 4))
    for seed in range(4000):
        for b in range(3):
            counts[b] += sharding.matrix_row(seed, ends, cells, b)
    want = np.outer([4, 10, 10], [0.25] * 4) * 4000
    assert np.abs(counts / want - 1).max() < 0.04
    df = spark.range(24).repartition(3)
    first = [r.id for r in sharding.shuffle_into_shards(df, 2, seed=1).orderBy("shard", "slot").collect()]
    other = [r.id for r in sharding.shuffle_into_shards(df, 2, seed=2).orderBy("shard", "slot").collect()]
    assert first != other and first != sorted(first)


def test_fewer_rows_than_shards_and_none(spark):
    out = sharding.shuffle_into_shards(spark.range(3), 8)
    assert sorted((r.shard, r.slot) for r in out.collect()) == [(0, 0), (1, 0), (2, 0)]
    assert sharding.shuffle_into_shards(spark.range(0), 8).collect() == []


@pytest.mark.parametrize("fan", [3, 1000])
def test_rows_dealt_in_steps_are_whole(spark, fan, monkeypatch):
    """Several exchanges, with blocks of at most 8 rows and cells of at most 2."""
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 8)
    rows = [(i % 50, "t" * (i % 9)) for i in range(103)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = sharding.shuffle_into_shards(df, 5, seed=4, cell_rows=2, fan=fan)
    assert out.columns == ["doc_id", "text", "shard", "slot"]
    got = out.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    assert sorted((r.shard, r.slot) for r in got) == [(s, k) for s in range(5) for k in range(21 if s < 3 else 20)]
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, got))


def test_places_are_even_when_dealt_in_steps(spark):
    """The steps by hand, for 3 groups of parts: every row of every block reaches every cell equally often."""
    cells, counts = np.full(6, 4), np.zeros((24, 6))
    for seed in range(3000):
        first = sharding.Deal(seed, 0, [(0, 0, 0, 4), (0, 1, 0, 20)], np.add.reduceat(cells, [0, 2, 4]), 3)
        parts = np.concatenate([first.labels(0, b)[0] for b in (0, 1)])
        held = [np.flatnonzero(parts == g) for g in range(3)]
        second = sharding.Deal(seed, 1, [(g, b, 4 * b, 4) for g in range(3) for b in (0, 1)], cells, 2)
        for g in range(3):
            for b in (0, 1):
                labels, lots, start = second.labels(g, b)
                assert len(labels) == len(lots) == 4 and start == 4 * b
                counts[held[g][start:start + 4], labels] += 1
    assert counts.sum(axis=1).tolist() == [3000] * 24
    assert np.abs(counts / 500 - 1).max() < 0.2


def test_cells_shrink_with_long_rows(spark, monkeypatch):
    """Cells of at most 1,000 bytes on the average: 40 rows of 401 bytes lie two in a cell."""
    monkeypatch.setattr(sharding, "CELL_BYTES", 1000)
    seen = []
    dealt = sharding._dealt
    monkeypatch.setattr(sharding, "_dealt", lambda rows, deal: seen.append(deal.parts) or dealt(rows, deal))
    df = spark.range(40).selectExpr("id", "repeat('x', 400) AS text")
    assert len(sharding.shuffle_into_shards(df, 2).collect()) == 40
    assert seen[-1].tolist() == [2] * 20


def test_a_row_of_the_matrix_is_quick_at_many_blocks():
    ends = np.cumsum(np.full(100_000, 16_000))
    cells = np.full(sharding.FAN, 16_000 * 100_000 // sharding.FAN)
    cells[: int(ends[-1] - cells.sum())] += 1
    started = time.perf_counter()
    assert sharding.matrix_row(1, ends, cells, 77_777).sum() == 16_000
    assert time.perf_counter() - started < 0.5  # about a tenth of it on an idle machine
