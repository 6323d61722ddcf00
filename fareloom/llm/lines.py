"""Line dedup by winnowing over line hashes, in DataFrame functions only.

A line ends at a line break or behind a full stop, question or exclamation mark and a blank, so a passage that was
put into a paragraph still begins and ends with a line. A *gram* is one line of ``LONG_LINE`` words or more, or three
lines in a row. Long lines are always fingerprints; of the other grams, those that are least in a window of
three. Any repeated passage of more than 50 words made of whole lines has a fingerprint in every copy: it holds a
long line, or five shorter lines and so three grams.

Fingerprints that stand at more than one place are matched by a join. Matches are extended both ways line by line: a
*link* is a line and the next one, or a long line alone, and all links within ``BEFORE`` and ``AFTER`` lines of a repeated
fingerprint are joined in turn. A repeated passage has a fingerprint within that reach of each of its lines, at every
one of its places, so all its links are there, and each meets its first place wherever that is: the parts of a passage
may have their first places in different documents. Lines of links that have an earlier place are matched; runs of
them are deleted if they hold enough words. No pair of copies is ever made: each link meets one first place, which is a
minimum with a map side, and no document gathers its copies. Both sides of every join grow with the documents, so all
are merge joins, at any size: what a broadcast would save on few documents says nothing about many.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, land

LONG_LINE = 12
#: How far the first line of a passage lies before a fingerprint in it at most, and its last line behind one's first line.
BEFORE = 3
AFTER = 4
#: A matched run of fewer words stays: short repeated phrases are ordinary text.
MIN_WORDS = 25
#: Marks the end of a line for the fast split; texts that hold it themselves are split by pattern.
_MARK = "\ue000"
_PIECES = "if(contains({0}, '%s'), split({0}, '(?<=\\\\n)|(?<=[.!?] )', -1), split(%s, '%s', -1))" % (
    _MARK, reduce(lambda text, end: f"replace({text}, '{end}', '{end}{_MARK}')", ["\\n", ". ", "! ", "? "], "{0}"), _MARK)


def _line_table(docs: DataFrame) -> DataFrame:
    """Per document: hashes ``h`` and word counts ``w`` of its lines, without blanks around them."""
    bare = "trim(BOTH ' \\t\\r\\n' FROM x)"
    return (docs.select("d", "t", F.expr(f"transform({_PIECES.format('text')}, x -> {bare})").alias("lines"))
            .select("d", "t", F.expr("transform(lines, x -> xxhash64(x))").alias("h"),
                    F.expr("transform(lines, x -> if(x = '', 0, length(x) - length(replace(x, ' ', '')) + 1))").alias("w")))


def _fingerprints(lines: DataFrame) -> DataFrame:
    """(d, t, p, g): the selected grams ``g`` by the place ``p`` of their first line."""
    gram = (f"transform(h, (x, i) -> if(w[i] >= {LONG_LINE}, xxhash64(x), "
            f"if(i + 2 < size(h), xxhash64(x, get(h, i + 1), get(h, i + 2)), null)))")
    top = "9223372036854775807L"
    least = "transform(k, (x, i) -> least(" + ", ".join(f"coalesce(get(k, i + {n}), {top})" for n in range(3)) + "))"
    chosen = (f"filter(transform(k, (x, i) -> if(x is not null and (w[i] >= {LONG_LINE} or x = m[i] "
              "or coalesce(x = get(m, i - 1), false) or coalesce(x = get(m, i - 2), false)), "
              "struct(i as p, x as g), null)), s -> s is not null)")
    return (lines.select("d", "t", "w", F.expr(gram).alias("k"))
            .select("d", "t", "w", "k", F.expr(least).alias("m"))
            .select("d", "t", F.expr(f"inline({chosen})")))


def _repeated(grams: DataFrame) -> DataFrame:
    """(g): the grams that stand at more than one place."""
    return grams.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g")


def _links(lines: DataFrame, grams: DataFrame, repeated: DataFrame) -> DataFrame:
    """(k, d, t, p, n, m): links ``k`` near repeated grams, by the place ``p`` of their first line, with the word counts of
    that line and the next (null: a long line alone)."""
    seeds = grams.join(repeated.hint("merge"), "g").groupBy("d", "t").agg(F.collect_set("p").alias("seeds"))
    near = (f"array_distinct(flatten(transform(seeds, s -> "
            f"sequence(greatest(s - {BEFORE}, 0), least(s + {AFTER}, size(h) - 1)))))")
    pair = "if(i + 1 < size(h), struct(xxhash64(h[i], get(h, i + 1)) as k, i as p, w[i] as n, get(w, i + 1) as m), null)"
    alone = f"if(w[i] >= {LONG_LINE}, struct(xxhash64(h[i]) as k, i as p, w[i] as n, cast(null as int) as m), null)"
    return (seeds.join(lines.hint("merge"), ["d", "t"]).withColumn("near", F.expr(near))
            .select("d", "t", F.expr(f"inline(filter(flatten(transform(near, i -> array({pair}, {alone}))), "
                                     "s -> s is not null))")))


def _firsts(links: DataFrame) -> DataFrame:
    """(k, s): the first place of every link that occurs more than once."""
    return (links.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("d", "t", "p")).alias("s"))
            .where("c > 1").select("k", "s"))


def _matched_lines(links: DataFrame, firsts: DataFrame) -> DataFrame:
    """(d, t, p, n): places of lines that repeat earlier ones, with their word counts."""
    later = links.join(firsts.hint("merge"), "k").where("struct(d, t, p) != s")
    both = "if(m is null, array(struct(p as p, n as n)), array(struct(p as p, n as n), struct(p + 1 as p, m as n)))"
    return later.select("d", "t", F.expr(f"inline({both})")).distinct()


def _runs(matched: DataFrame, min_words: int) -> DataFrame:
    """(d, t, runs): runs of matched places with enough words, as sorted (a, b) from place a up to before b."""
    island = F.col("p") - F.expr("row_number() over (partition by d, t order by p)")
    return (matched.withColumn("island", island).groupBy("d", "t", "island")
            .agg(F.min("p").alias("a"), (F.max("p") + 1).alias("b"), F.sum("n").alias("words"))
            .where(F.col("words") >= min_words)
            .groupBy("d", "t").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("runs"),
                                   F.sum("words").alias("words")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` with the repeated runs cut out of the text, and ``removed_lines`` and
    ``removed_words`` (bigints; columns of those names are replaced).

    A run of lines goes if each of its lines occurred earlier (in a document with a smaller id, or before it in the same
    one) next to a neighbour it has in the run, or is a long line that occurred earlier, and if the run has ``min_words`` words
    or more; what remains keeps its spelling and order, and first occurrences are never touched. Only the surroundings of
    repeated fingerprints are looked at, so runs of 50 words or fewer may stay. Lines are compared without the blanks around
    them. A text all of whose lines are repeated becomes empty, its row stays. Null texts stay null, empty ones
    empty. Rows that agree in id and text count as one document and are treated alike; rows without an id come
    last. A passage may be spread over thousands of documents: each place meets the first one only. Empty tables stay
    empty.
    """
    outputs = {"removed_lines", "removed_words"}
    kept = [F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c)
            for c in docs.columns if c.lower() not in outputs]
    text = F.col(text_col)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("d"),
                       F.xxhash64(text).alias("t"), text.alias("text"),
                       F.struct(F.lit(0).alias("0"), *[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"))
    lines, lines_path = land(_line_table(rows.where("text != ''")), "lines")
    # Landed, so that the joins have plain shuffles on both sides, whose hot keys can be split.
    repeated, repeated_path = land(_repeated(_fingerprints(lines)), "line-grams")
    links, links_path = land(_links(lines.dropDuplicates(["d", "t"]), _fingerprints(lines), repeated), "line-links")
    for path in (lines_path, repeated_path):
        discard(docs.sparkSession, path)
    firsts, firsts_path = land(_firsts(links), "line-firsts")
    runs, _ = land(_runs(_matched_lines(links, firsts), min_words), "line-runs")
    for path in (links_path, firsts_path):
        discard(docs.sparkSession, path)
    pieces = _PIECES.format("text")
    before = "transform(runs, (r, i) -> struct(if(i = 0, 0, get(runs, i - 1).b) as a, r.a as b))"
    rest = f"concat({before}, array(struct(element_at(runs, -1).b as a, size(pieces) as b)))"
    cut = rows.join(runs.hint("merge"), ["d", "t"], "left").withColumn("pieces", F.when(F.col("runs").isNotNull(), F.expr(pieces)))
    left = F.expr(f"array_join(flatten(transform({rest}, r -> slice(pieces, r.a + 1, r.b - r.a))), '')")
    return cut.select(
        "row", "words", "runs", F.when(F.col("runs").isNull(), F.col("text")).otherwise(left).alias("text")
    ).select(*kept, F.expr("coalesce(aggregate(runs, 0L, (n, r) -> n + r.b - r.a), 0L)").alias("removed_lines"),
             F.coalesce(F.col("words").cast("long"), F.lit(0)).alias("removed_words"))
