"""SimHash near-duplicates by segment popcounts.

A 64-bit fingerprint is cut into 32 segments of two bits. The counts of set bits per segment, each 0 to 2,
are a point of a grid; the Manhattan distance of two points never exceeds the Hamming distance of the two
fingerprints. So fingerprints within ``MAX_BITS`` bits lie within as many steps on the grid.

The segments fall into three groups. Four steps spread over three groups leave two groups that hold two steps
or fewer together. The range join therefore works on each pair of groups (42 or 44 bits): a fingerprint writes
itself to its own grid point there and to every neighbouring one, one step away; points within two steps of
each other have such a point in common.

Fingerprints that meet at a crowded point are not paired. They write themselves to all 64-bit patterns
within two bits; those that meet there are within four bits of each other, so the smallest stands for the
rest without a pair being tested, and every link is still found. At most 2,081 fingerprints can meet at a
pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, discard, land
from .fingerprints import simhash_column

MAX_BITS = 4
#: Up to so many fingerprints of one grid point are compared with each other.
CROWD = 64

_LOW = 0x5555555555555555
_GROUPS = [range(0, 11), range(11, 22), range(22, 32)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def segment_popcounts(fp: Column) -> Column:
    """The 32 counts, packed into the two bits of their segments."""
    low = fp.bitwiseAND(F.lit(_LOW))
    high = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_LOW))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def manhattan(p: Column, q: Column) -> Column:
    """Steps between two packed grid points. Per segment the xor is 0, 1, 2 or, between 1 and 2, 3."""
    x = p.bitwiseXOR(q)
    low = x.bitwiseAND(F.lit(_LOW))
    high = F.shiftrightunsigned(x, 1).bitwiseAND(F.lit(_LOW))
    return F.bit_count(low) + 2 * F.bit_count(high) - 2 * F.bit_count(low.bitwiseAND(high))


def _moves() -> Column:
    """For each pair of groups: stay, or one step up or down in one segment. Each as the mask of the pair,
    the mark that tells the pairs apart (3, which no count is, in a segment left out), shift and step."""
    out = []
    for left_out in _GROUPS:
        kept = [s for s in range(32) if s not in left_out]
        mask = _signed(sum(3 << 2 * s for s in kept))
        mark = _signed(3 << 2 * left_out[0])
        steps = [(0, 0)] + [(s, d) for s in kept for d in (1, -1)]
        out += [F.struct(F.lit(mask).cast("long").alias("mask"), F.lit(mark).cast("long").alias("mark"),
                         F.lit(2 * s).alias("at"), F.lit(d).alias("step")) for s, d in steps]
    return F.array(*out)


def grid_points(fps: DataFrame) -> DataFrame:
    """(point, fp) for every distinct ``fp``: its own and its neighbouring points in each pair of groups."""
    moved = fps.select("fp", segment_popcounts(F.col("fp")).alias("v"), F.explode(_moves()).alias("m"))
    old = F.expr("shiftrightunsigned(v, m.at)").bitwiseAND(F.lit(3).cast("long"))
    stepped = moved.withColumn("old", old).where("m.step = 0 or old + m.step between 0 and 2")
    return stepped.select(F.expr("((v & m.mask) ^ shiftleft(old ^ (old + m.step), m.at)) | m.mark").alias("point"), "fp")


def _lowest_segment(x: Column) -> Column:
    marked = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(_LOW))
    return marked.bitwiseAND(-marked)


def _linked_here(point: Column, x: Column, y: Column, max_bits: int) -> Column:
    """Whether two fingerprints that meet at ``point`` are linked, and this is the one point that says so: in
    the first pair of groups in which they are two steps apart or fewer, at the point of ``x``, or one step
    from it in the lowest segment in which they differ."""
    p, q = segment_popcounts(x), segment_popcounts(y)
    told, earlier = F.lit(False), F.lit(True)
    for left_out in _GROUPS:
        mask = F.lit(_signed(sum(3 << 2 * s for s in range(32) if s not in left_out))).cast("long")
        here = F.shiftrightunsigned(point, 2 * left_out[0]).bitwiseAND(F.lit(3)) == 3
        own, apart = p.bitwiseAND(mask), manhattan(p.bitwiseAND(mask), q.bitwiseAND(mask))
        moved, differ = own.bitwiseXOR(point.bitwiseAND(mask)), p.bitwiseXOR(q).bitwiseAND(mask)
        first = F.when(apart < 2, moved == 0).otherwise(_lowest_segment(moved) == _lowest_segment(differ))
        told = told | (here & earlier & first)
        earlier = earlier & (apart > 2)
    return ((x < y) & (manhattan(p, q) <= max_bits)  # the lower bound, and then the exact distance
            & (F.bit_count(x.bitwiseXOR(y)) <= max_bits) & told)


def _patterns(fps: DataFrame, bits: int) -> DataFrame:
    """(pattern, fp): all patterns within ``bits`` (0 to 2) bits of each fingerprint."""
    turned = F.col("fp")
    out = fps.select("fp")
    for name, above in (("i", None), ("j", "i"))[:bits]:
        top = F.lit(63) if above is None else F.greatest(F.col(above) - 1, F.lit(-1))  # -1: turns no bit
        out = out.withColumn(name, F.explode(F.sequence(F.lit(-1), top)))
        turned = turned.bitwiseXOR(F.when(F.col(name) < 0, F.lit(0)).otherwise(F.expr(f"shiftleft(1L, {name})")))
    return out.select(turned.alias("pattern"), "fp")


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (``a``, ``b``) between distinct fingerprints ``fp``; exactly those fingerprints are connected by
    them that are connected by steps of at most ``max_bits`` (0, 2 or 4) bits."""
    if max_bits not in (0, 2, MAX_BITS):
        raise ValueError("max_bits must be 0, 2 or 4")
    met, path = land(grid_points(fps).withColumn("n", F.expr("count(1) over (partition by point)"))
                     .where("n > 1"), "grid-points")
    few = met.where(F.col("n") <= CROWD)
    x, y = few.select("point", F.col("fp").alias("x")), few.select("point", F.col("fp").alias("y"))
    pairs = (x.join(y, "point").where(_linked_here(F.col("point"), F.col("x"), F.col("y"), max_bits))
             .select(F.col("x").alias("a"), F.col("y").alias("b")))
    crowded = met.where(F.col("n") > CROWD).select("fp").distinct()
    stars = (_patterns(crowded, max_bits // 2).withColumn("b", F.expr("min(fp) over (partition by pattern)"))
             .where("fp != b").select(F.col("fp").alias("a"), "b"))
    links, _ = land(pairs.union(stars).distinct(), "fingerprint-links")
    discard(fps.sparkSession, path)
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (long), ``component_id``.

    ``component_id`` is the smallest id of the documents reachable over links of at most ``max_bits`` bits.
    Copies share a fingerprint and are counted once, whatever their number. Null and empty texts have
    fingerprint zero and link like any other. Repeated rows give repeated results; a row without an id gets
    a component like any other, but its id names none (the component of such rows alone is null). An empty
    table gives an empty result. Only the id and the text are read, so other columns may have any name.
    """
    prints, _ = land(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                 simhash_column(F.col(text_col), shingle).alias("fp")), "fingerprints")
    classes, _ = land(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-classes")
    links = fingerprint_links(classes.select("fp"), max_bits)
    # The components are those of the fingerprints themselves; ids come in afterwards, so a null or shared
    # id cannot join or part them.
    groups = components(links)
    # Both sides of the join are landed, so that a component of very many fingerprints can be split.
    smallest, _ = land(classes.join(groups, F.col("fp") == F.col("node"), "left")
                       .select("fp", "first", F.coalesce("component", "fp").alias("root")), "fingerprint-roots")
    least, _ = land(smallest.groupBy("root").agg(F.min("first").alias("component_id")), "component-ids")
    named = smallest.join(least, "root").select("fp", "component_id")
    return (prints.join(named, "fp")
            .select("doc_id", F.col("fp").alias("fingerprint"), "component_id"))
