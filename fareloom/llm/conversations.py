"""The prefix trie of conversations, with totals of every subtree by parallel tree contraction.

Turns are put in order by a range shuffle and numbered in two passes: each task counts the turns of a conversation in
its own range, and one row per range tells how many lie in the ranges before. So a conversation that holds a third
of all turns is spread over many tasks. The same two passes give every turn the hash of the turns up to it, a polynomial
modulo ``2 ** 127 - 1`` in 128-bit hashes of single turns; equal hashes are one node.

Subtree totals come from rounds of joins, whose number follows the logarithm of the nodes, not the depth of the tree:

* *rake*: nodes without children are final, and what they hold is added to their parents;
* *compress*: of nodes with one child, an independent set is taken out. The child hangs from the grandparent then and
  remembers what the node held. In a chain the nodes whose depth has fewer trailing zero bits than that of both their
  neighbours go, so a chain halves in each round.

When nothing is left, the rounds are undone from the last to the first: the total of a node taken out is what it held,
what its child remembered of nodes between the two, and the total of that child. Each round is landed; those tables shrink geometrically.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, land

_PRIME = (1 << 127) - 1
_BASE = 0x5851F42D4C957F2D14057B7EF767814F
_LOW = (1 << 64) - 1
#: Ids of one node are joined to text in stretches of so many possible ids.
ID_STRETCH = 512


def _cut(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the number of the range and the place within the conversation, counted in this range alone."""
    part, held, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        c = batch.column("conv_id").to_numpy(zero_copy_only=False)
        if not len(c):
            continue
        starts = _cut(c)
        place = np.arange(1, len(c) + 1) - np.repeat(starts, np.diff(np.append(starts, len(c))))
        if held == c[0]:
            place[:np.append(starts, len(c))[1]] += seen
        held, seen = c[-1], int(place[-1])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), part)), pa.array(place), *batch.columns],
                                         ["part", "place", *batch.schema.names])


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers turns as ``_number`` and adds the hash of the turns before (``p1``, ``p2``) and up to (``h1``, ``h2``) each,
    again of this range alone."""
    part, held, seen, code = TaskContext.get().partitionId(), None, 0, 0
    for batch in batches:
        c = batch.column("conv_id").to_pylist()
        place, before, upto = [], [], []
        for key, k1, k2 in zip(c, batch.column("key1").to_pylist(), batch.column("key2").to_pylist()):
            if key != held:
                held, seen, code = key, 0, 0
            before.append(code)
            code = (code * _BASE + ((k1 & _LOW) << 64 | (k2 & _LOW))) % _PRIME
            upto.append(code)
            seen += 1
            place.append(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(c), pa.int64()), batch.column("conv_id"), pa.array(place, pa.int64()),
             *_halves(before), *_halves(upto), batch.column("size")],
            ["part", "conv_id", "depth", "p1", "p2", "h1", "h2", "size"])


def _halves(codes: list[int]) -> list[pa.Array]:
    low = np.array([x & _LOW for x in codes], np.uint64).view(np.int64)
    return [pa.array([x >> 64 for x in codes], pa.int64()), pa.array(low)]


def _whole(h1: int, h2: int) -> int:
    return h1 << 64 | (h2 & _LOW)


def _carried(ends: list) -> dict[int, tuple[int, int, int]]:
    """For each range that begins inside a conversation: that conversation, and the number and hash of its turns in
    the ranges before. ``ends``: one row per range, in order."""
    out, held = {}, None
    for r in ends:
        if held is not None and held[0] == r.first:
            out[r.part] = held
        c, n, code = r.last[0], r.last[1], _whole(*r.last[2:])
        if r.first == c and r.part in out:
            code = (out[r.part][2] * pow(_BASE, n, _PRIME) + code) % _PRIME
            n += out[r.part][1]
        held = (c, n, code)
    return out


def _ends(rows: DataFrame, *last: str) -> list:
    return rows.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", *last)).alias("last")
                                    ).orderBy("part").collect()


def place_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """``conv_id``, ``place`` (from 1), ``key1``, ``key2`` (hashes of role and text) and ``size`` (UTF-8 bytes of the text)
    of every row, landed.

    Turns are ordered by number, null first; rows of one number by role, then by text. Null roles and texts count as
    empty. Repeated rows are turns of their own. Rows without a conversation take no part. Other columns are not read.
    """
    rows = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("conv_id is not null")
    # The bounds of the ranges go to the driver: long roles and texts are not cut in two, but do not go there whole.
    ranges = [F.col("turn").asc_nulls_first(), F.substring("role", 1, 32),
              F.when(F.length("role") <= 32, F.substring("text", 1, 32)).otherwise("")]
    ordered = (rows.repartitionByRange("conv_id", *ranges)
               .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
               .select("conv_id", F.xxhash64("role", "text").alias("key1"), F.xxhash64("text", "role", F.lit(7)).alias("key2"),
                       F.octet_length("text").cast("long").alias("size")))
    schema = "part long, place long, conv_id long, key1 long, key2 long, size long"
    placed, _ = land(ordered.mapInArrow(_number, schema), "turns")
    known = _carried(_ends(placed, "place", F.lit(0).cast("long"), F.lit(0).cast("long")))
    # One row per range of the shuffle at most, whatever the number of turns.
    shift = turns.sparkSession.createDataFrame([(p, c, n) for p, (c, n, _) in known.items()], "part long, conv_id long, n long")
    return placed.join(F.broadcast(shift), ["part", "conv_id"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("n", F.lit(0))).alias("place"), "key1", "key2", "size")


def _prefixes(placed: DataFrame) -> DataFrame:
    """Every turn with its depth, the hash of the turns up to it and of those before it, landed."""
    ordered = (placed.select("conv_id", "place", "key1", "key2", "size").repartitionByRange("conv_id", "place")
               .sortWithinPartitions("conv_id", "place").select("conv_id", "key1", "key2", "size"))
    schema = "part long, conv_id long, depth long, p1 long, p2 long, h1 long, h2 long, size long"
    local, path = land(ordered.mapInArrow(_hash, schema), "prefixes")
    known = _carried(_ends(local, "depth", "h1", "h2"))
    if not known:
        return local

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.to_pydict()
            for i, part in enumerate(columns["part"]):
                if part in known and known[part][0] == columns["conv_id"][i]:
                    _, n, code = known[part]
                    for a, b, steps in (("p1", "p2", columns["depth"][i] - 1), ("h1", "h2", columns["depth"][i])):
                        x = (code * pow(_BASE, steps, _PRIME) + _whole(columns[a][i], columns[b][i])) % _PRIME
                        columns[a][i] = x >> 64
                        columns[b][i] = (x & _LOW) - (1 << 64) if x >> 63 & 1 else x & _LOW
                    columns["depth"][i] += n
            yield pa.RecordBatch.from_pydict(columns, schema=batch.schema)
    whole, _ = land(local.mapInArrow(joined, schema), "prefixes")
    discard(placed.sparkSession, path)
    return whole


def _rank(depth: Column) -> Column:
    """Trailing zero bits first, then the depth: no two nodes of a chain have the same."""
    zeros = F.bit_count(depth.bitwiseAND(-depth) - 1)
    return F.struct(zeros, depth)


def _contract(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """``conv_id``, ``depth`` and the totals over its subtree of the columns ``sums`` of every node.

    ``nodes``: ``conv_id``, ``depth``, ``parent_conv_id`` (null: a root) and the columns, for a forest in which a
    parent lies one step higher.
    """
    spark, node = nodes.sparkSession, ["conv_id", "depth"]
    state = nodes.select(*node, F.col("parent_conv_id").alias("pc"),
                         F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1).alias("pd"),
                         *sums, *[F.lit(0).cast("long").alias(f"up_{s}") for s in sums], F.lit(False).alias("awaited"))
    finals, taken, path, left = [], [], None, 1
    while left:
        kids = (state.where("pc is not null").groupBy("pc", "pd")
                .agg(F.count(F.lit(1)).alias("k"), F.min(F.struct(*node)).alias("only"))
                .select(F.col("pc").alias("conv_id"), F.col("pd").alias("depth"), "k", "only"))
        here, here_path = land(state.join(kids, node, "left").withColumn("k", F.coalesce("k", F.lit(0).cast("long"))), "trie-round")
        other = here.select(F.col("conv_id").alias("oc"), F.col("depth").alias("od"), "k", F.col("pc").isNotNull().alias("inner"),
                            *[F.col(f"up_{s}").alias(f"between_{s}") for s in sums])
        above = other.select(F.col("oc").alias("pc"), F.col("od").alias("pd"), (F.expr("k = 1 and inner")).alias("above"))
        below = other.select(F.col("oc").alias("uc"), F.col("od").alias("ud"), F.col("k").alias("below"),
                             *[f"between_{s}" for s in sums])
        chain = (here.where("k = 1 and pc is not null").select("*", F.col("only.conv_id").alias("uc"), F.col("only.depth").alias("ud"))
                 .drop("k", "only").join(above, ["pc", "pd"]).join(below, ["uc", "ud"]))
        rank = _rank(F.col("depth"))
        out, out_path = land(chain.where((F.col("below") > 0)
                                         & (~F.col("above") | (rank < _rank(F.col("pd"))))
                                         & ((F.col("below") > 1) | (rank < _rank(F.col("ud"))))).drop("above", "below"), "trie-taken")
        none = F.lit(None).cast("long")
        raked = (here.where("k = 0 and pc is not null").groupBy("pc", "pd")
                 .agg(*[F.sum(F.col(s) + F.col(f"up_{s}")).alias(f"add_{s}") for s in sums])
                 .select(F.col("pc").alias("conv_id"), F.col("pd").alias("depth"), *[f"add_{s}" for s in sums],
                         none.alias("npc"), none.alias("npd"), *[none.alias(f"lift_{s}") for s in sums], F.lit(False).alias("gone")))
        moved = out.select(F.col("uc").alias("conv_id"), F.col("ud").alias("depth"), *[none.alias(f"add_{s}") for s in sums],
                           F.col("pc").alias("npc"), F.col("pd").alias("npd"),
                           *[(F.col(s) + F.col(f"up_{s}")).alias(f"lift_{s}") for s in sums], F.lit(False).alias("gone"))
        gone = out.select(*node, *[none.alias(c) for c in moved.columns[2:-1]], F.lit(True).alias("gone"))
        change = raked.union(moved).union(gone).groupBy(*node).agg(*[F.max(c).alias(c) for c in moved.columns[2:]])
        after = here.join(change, node, "left").where("not coalesce(gone, false)").select(
            *node, F.coalesce("npc", "pc").alias("pc"), F.coalesce("npd", "pd").alias("pd"),
            *[(F.col(s) + F.coalesce(f"add_{s}", F.lit(0))).alias(s) for s in sums],
            *[(F.col(f"up_{s}") + F.coalesce(f"lift_{s}", F.lit(0))).alias(f"up_{s}") for s in sums],
            (F.col("awaited") | F.col("npc").isNotNull()).alias("awaited"), (F.col("k") == 0).alias("final"))
        landed, landed_path = land(after, "trie-state")
        finals.append(landed.where("final").select(*node, *sums, "awaited"))
        left, some = (landed.where("not final").select(F.lit(1).alias("a"), F.lit(0).alias("b"))
                      .union(out.select(F.lit(0), F.lit(1))).agg(F.count_if(F.expr("a = 1")), F.count_if(F.expr("b = 1"))).first())
        if some:
            taken.append((out, out_path))
        else:
            discard(spark, out_path)
        discard(spark, here_path)
        state, path = landed.where("not final").drop("final"), landed_path

    def union(frames: list[DataFrame]) -> DataFrame:
        whole = frames[0]
        for frame in frames[1:]:
            whole = whole.union(frame)
        return whole
    expanded: list[DataFrame] = []
    for out, out_path in reversed(taken):
        known = union(finals + expanded).where("awaited").select(
            F.col("conv_id").alias("uc"), F.col("depth").alias("ud"), *[F.col(s).alias(f"of_{s}") for s in sums])
        totals, _ = land(out.join(known, ["uc", "ud"]).select(*node, *[(F.col(s) + F.col(f"between_{s}") + F.col(f"of_{s}")).alias(s)
                                                                       for s in sums], "awaited"), "trie-expanded")
        expanded.append(totals)
        discard(spark, out_path)
    return union(finals + expanded).select(*node, *sums)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined id texts of each node; a node's rows come in a row and in order."""
    held, digest = None, None
    for batch in batches:
        out = []
        for c, d, ids in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "depth", "ids"))):
            if (c, d) != held:
                if held is not None:
                    out.append((*held, digest.hexdigest()))
                held, digest = (c, d), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if out:
            yield _ended(out)
    if held is not None:
        yield _ended([(*held, digest.hexdigest())])


def _ended(rows: list[tuple]) -> pa.RecordBatch:
    c, d, ends = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(d, pa.int64()), pa.array(ends)],
                                      ["conv_id", "depth", "ends_sha256"])


def prefix_trie(placed: DataFrame, members: DataFrame) -> DataFrame:
    """One row per node of the trie of all conversations.

    ``placed``: turns as ``place_turns`` gives them (any rising ``place`` will do). ``members``: all conversations
    (``conv_id``); those without a turn end at the root. Returns longs ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id`` (smallest member of the parent; null for the root), ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (bytes that one stored copy of each turn saves, over the subtree) and string ``ends_sha256`` (of the
    ids of the conversations that end here). A node's own turn is turn number ``depth`` of conversation ``conv_id``.

    Repeated ids of ``members`` count once, null ids not at all. Copies of a whole conversation, however many, are
    members of the same nodes. An empty table has no node. Hot nodes: members, children and totals are counted with a
    map side; ids that end at one node are joined in stretches of ``ID_STRETCH`` ids, and the stretches of a node
    stream through one task, as the digest of their sequence demands.
    """
    node, none = ["conv_id", "depth"], F.lit(None).cast("long")
    ids = members.select(F.col("conv_id").cast("long").alias("conv_id")).where("conv_id is not null").distinct()
    turns = _prefixes(placed)
    whole = (turns.groupBy("depth", "h1", "h2")
             .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("p1").alias("p1"),
                  F.max("p2").alias("p2"), F.max("size").alias("size")))
    zero = F.lit(0).cast("long")
    root = (ids.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
            .select(zero.alias("depth"), zero.alias("h1"), zero.alias("h2"), "conv_id", "n_convs", none.alias("p1"), none.alias("p2"),
                    zero.alias("size")))
    found, found_path = land(whole.unionByName(root), "trie-nodes")
    parents = found.select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"),
                           F.col("conv_id").alias("parent_conv_id"))
    saved = ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens")
    tree, tree_path = land(found.join(parents, ["depth", "p1", "p2"], "left").select(*node, "parent_conv_id", "n_convs", saved), "trie-tree")
    kids = (tree.where("parent_conv_id is not null").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
            .agg(F.count(F.lit(1)).alias("n_children")))
    trie, _ = land(tree.join(kids, node, "left").withColumn("n_children", F.coalesce("n_children", zero))
                   .withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")), "trie")
    discard(placed.sparkSession, tree_path)
    totals = _contract(trie, ["n_leaves", "saved_tokens"])
    last = turns.groupBy("conv_id").agg(F.max(F.struct("depth", "h1", "h2")).alias("end"))
    ended = (ids.join(last, "conv_id", "left")
             .select(F.col("conv_id").alias("id"), *[F.coalesce(F.col(f"end.{c}"), zero).alias(c) for c in ("depth", "h1", "h2")])
             .join(found.select("depth", "h1", "h2", "conv_id"), ["depth", "h1", "h2"])
             .groupBy(*node, F.floor(F.col("id") / ID_STRETCH).alias("stretch"))
             .agg(F.array_join(F.sort_array(F.collect_list("id")).cast("array<string>"), ",").alias("ids")))
    digests, _ = land(ended.repartition(*node).sortWithinPartitions(*node, "stretch").select(*node, "ids")
                      .mapInArrow(_digest, "conv_id long, depth long, ends_sha256 string"), "trie-ends")
    discard(placed.sparkSession, found_path)
    return (trie.drop("n_leaves", "saved_tokens").join(totals, node).join(digests, node, "left")
            .select(*node, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
