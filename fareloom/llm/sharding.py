"""A uniform shuffle into shards of exact sizes by communication matrices.

The rows of the landed input lie in blocks (pieces of the partitions it was written by). The shards are cut into cells
of bounded size. How many rows of each block go to each cell follows the multivariate hypergeometric law with the
block sizes and cell sizes as margins; a block then deals its rows by a random permutation of its cell labels,
the rows are exchanged, and each cell is permuted again. Every order of all rows is equally likely.

A matrix of blocks and cells grows with the square of the rows. Beyond ``FAN`` cells the rows are therefore dealt in
steps: first to at most ``FAN`` ranges of cells, landed there in new blocks, then every range by a matrix of its own
blocks and parts, until the parts are cells. Each step is a uniform deal into parts of exact sizes, so the whole is.

No matrix is ever held whole. It is drawn by halving the range of blocks: the upper half's share of every part
is one multivariate hypergeometric draw, whose generator is seeded by the range. A task follows the halving down
to its own block, so all tasks agree on the matrix without exchanging it, and a repeated task draws the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, land

#: Rows of a cell at most, and its bytes on the average at most: a cell is ordered by one task.
CELL_ROWS, CELL_BYTES = 1 << 14, 1 << 26
#: Rows of a block at most: a task holds the permutation of one.
BLOCK_ROWS = 1 << 18
#: Parts that one exchange deals a range of cells to.
FAN = 1 << 10
_EXACT = 10**9  # the library's sampler takes populations below this


def _generator(*key: int) -> np.random.Generator:
    return np.random.Generator(np.random.Philox(np.random.SeedSequence(key)))


def hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """How many of ``sample`` rows drawn without replacement are good. Beyond 10**9 rows by ratio of uniforms
    (Stadlober's HRUA); its acceptance test uses log-gamma, good to about 1e-5 at such sizes."""
    if good + bad < _EXACT:
        return int(rng.hypergeometric(good, bad, sample)) if sample else 0
    total, few, many, take = good + bad, min(good, bad), max(good, bad), min(sample, good + bad - sample)
    if not take or not few:
        drawn = 0
    else:
        share = few / total
        centre = take * share + 0.5
        spread = math.sqrt((total - take) * take * share * (1 - share) / (total - 1) + 0.5)
        width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
        mode = (take + 1) * (few + 1) // (total + 2)

        def weight(k):
            return sum(map(math.lgamma, (k + 1, few - k + 1, take - k + 1, many - take + k + 1)))
        peak, top = weight(mode), min(min(take, few) + 1, math.floor(centre + 16 * spread))
        while True:
            u, v = 1 - rng.random(), rng.random()
            at = centre + width * (v - 0.5) / u
            if 0 <= at < top:
                drawn = math.floor(at)
                if 2 * math.log(u) <= peak - weight(drawn):
                    break
    if good > bad:
        drawn = take - drawn
    return good - drawn if take < sample else drawn


def multivariate(rng: np.random.Generator, sizes: np.ndarray, sample: int) -> np.ndarray:
    """How many of ``sample`` rows fall on each of the colours with these sizes."""
    total = int(sizes.sum())
    if total < _EXACT:
        return rng.multivariate_hypergeometric(sizes, sample, method="marginals")
    out = np.zeros(len(sizes), np.int64)
    for k, size in enumerate(sizes.tolist()):
        total -= size
        out[k] = hypergeometric(rng, size, total, sample)
        sample -= int(out[k])
    return out


def matrix_row(seed: int, ends: np.ndarray, parts: np.ndarray, block: int, step: int = 0, group: int = 0) -> np.ndarray:
    """Rows of ``block`` for each part. ``ends``: rows up to and with each block."""
    low, high, share = 0, len(ends), parts
    while high - low > 1:
        middle = (low + high) // 2
        first = int(ends[middle - 1] - (ends[low - 1] if low else 0))
        drawn = multivariate(_generator(seed, 0, step, group, low, high), share, first)
        low, high, share = (low, middle, drawn) if block < middle else (middle, high, share - drawn)
    return share


class Deal:
    """One step: the blocks of each group (a range of cells) and the sizes of the parts it is dealt to.

    The parts of group g are those from g * fan on; one group holds all rows in the first step.
    """

    def __init__(self, seed: int, step: int, blocks: list[tuple[int, int, int, int]], parts: np.ndarray, fan: int):
        self.seed, self.step, self.parts, self.fan = seed, step, parts, fan
        table = np.array(sorted(blocks), np.int64).reshape(-1, 4)
        self.groups, self.blocks, self.starts, self.rows = table.T

    def labels(self, group: int, block: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The part and the lot of each row of a block, and the place of its first row."""
        low, high = np.searchsorted(self.groups, [group, group + 1])
        at = int(np.searchsorted(self.blocks[low:high], block))
        first = group * self.fan
        parts = self.parts[first:first + self.fan]
        share = matrix_row(self.seed, np.cumsum(self.rows[low:high]), parts, at, self.step, group)
        rng = _generator(self.seed, 1, self.step, group, at)
        dealt = rng.permutation(np.repeat(np.arange(first, first + len(parts), dtype=np.int32), share))
        return dealt, rng.integers(-1 << 63, 1 << 63, len(dealt), np.int64), int(self.starts[low + at])


def _blocks(rows: DataFrame) -> tuple[list[tuple[int, int, int, int]], int]:
    """(group, block, first place, rows) of every block, and the bytes of all."""
    found = rows.groupBy("_group", "_block").agg(F.min("_at"), F.count(F.lit(1)), F.sum("_bytes")).collect()
    return [tuple(r)[:4] for r in found], sum(r[4] for r in found)


def _numbered(rows: DataFrame) -> DataFrame:
    """Numbers the rows of each written partition: ``_block`` and the place ``_at`` in it."""
    bits = BLOCK_ROWS.bit_length() - 1
    number = F.monotonically_increasing_id()
    return rows.select("_row", "_bytes", "_group", F.shiftright(number, bits).alias("_block"),
                       number.bitwiseAND(F.lit((1 << bits) - 1)).alias("_at"))


def _dealt(rows: DataFrame, deal: Deal) -> DataFrame:
    plan = rows.sparkSession.sparkContext.broadcast(deal)

    @F.arrow_udf("struct<part: int, lot: bigint>")
    def draw(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        held = None
        for columns in batches:
            groups, blocks, at = (c.to_numpy(zero_copy_only=False) for c in columns)
            part, lot = np.zeros(len(at), np.int32), np.zeros(len(at), np.int64)
            for key in np.unique(np.stack([groups, blocks]), axis=1).T.tolist():
                if held is None or held[0] != key:
                    held = key, *plan.value.labels(*key)
                here = (groups == key[0]) & (blocks == key[1])
                part[here], lot[here] = held[1][at[here] - held[3]], held[2][at[here] - held[3]]
            yield pa.StructArray.from_arrays([pa.array(part), pa.array(lot)], ["part", "lot"])

    return rows.withColumn("_to", draw("_group", "_block", "_at"))


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 0, cell_rows: int = CELL_ROWS, fan: int = FAN) -> DataFrame:
    """All columns of ``df`` and ``shard`` (0 to ``shards`` - 1) and ``slot`` (from 0 without gaps in each
    shard), which replace columns of those names.

    Shard sizes differ by one at most (the first shards are the larger ones); which rows a shard holds, and in
    which order, is a uniform draw that the seed decides for the landed blocks. Only counts matter to it, so null
    and long values, ties and repeated rows go like all others; every row is kept. An empty table stays empty.
    A cell has at most ``cell_rows`` rows, fewer where rows of the mean size of their strings would exceed ``CELL_BYTES``. The
    driver holds four numbers per block and one size per cell. Rows are exchanged once for every factor ``fan`` in the
    number of cells (begun ones count), and landed before each exchange.
    """
    if shards < 1 or cell_rows < 1 or fan < 2:
        raise ValueError("shards and cell_rows must be positive, fan at least 2")
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    weight = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)).cast("long") for c in texts), F.lit(1).cast("long"))
    rows, path = land(_numbered(df.select(F.struct("*").alias("_row"), weight.alias("_bytes"), F.lit(0).alias("_group"))),
                      "shard-blocks")
    blocks, size = _blocks(rows)
    total = sum(b[3] for b in blocks)
    cell_rows = max(1, min(cell_rows, CELL_BYTES * total // max(1, size)))
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    per_shard = max(1, math.ceil(total / shards / cell_rows))
    cells = np.array([n // per_shard + (c < n % per_shard) for n in sizes for c in range(per_shard)], np.int64)
    steps = 1
    while fan ** steps < len(cells):
        steps += 1
    for step in range(steps - 1):
        width = fan ** (steps - 1 - step)
        parts = np.add.reduceat(cells, np.arange(0, len(cells), width))
        moved = _dealt(rows, Deal(seed, step, blocks, parts, fan)).select("_row", "_bytes", F.col("_to.part").alias("_group"))
        rows, landed = land(_numbered(moved.hint("rebalance", "_group").sortWithinPartitions("_group")), "shard-ranges")
        discard(df.sparkSession, path)
        blocks, path = _blocks(rows)[0], landed
    placed = _dealt(rows, Deal(seed, steps - 1, blocks, cells, fan)).withColumn("_n", F.expr(
        "row_number() over (partition by _to.part order by _to.lot, _block, _at)"))
    kept = [F.col(f"_row.`{c}`") for c in df.columns if c.lower() not in ("shard", "slot")]
    shard, cell = F.floor(F.col("_to.part") / per_shard).cast("int"), F.col("_to.part") % per_shard
    rows_of = F.lit(total // shards) + (shard < total % shards).cast("long")
    first = cell * F.floor(rows_of / per_shard) + F.least(cell.cast("long"), rows_of % per_shard)
    return placed.select(*kept, shard.alias("shard"), (first + F.col("_n") - 1).alias("slot"))
