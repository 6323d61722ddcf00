"""URL filters: a trie over reversed host labels and path segments, the longest matching rule wins.

The trie of a rule list whose text is at most ``MAX_TRIE_CHARS`` long is broadcast; that length is measured
first. A longer list is joined instead, on every host suffix and folder prefix of the distinct addresses,
with the same result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TRIE_CHARS = 16 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (lower-cased A-Z) and path of an address; both empty without ``://`` or for null."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.concat(url, F.lit("")), "://", 1))
    rest = F.coalesce(F.substr(url, F.length(rest) + 4), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.translate(str.maketrans(_UPPER, _LOWER)), slash + path


class Trie:
    """Nodes are [children, rule here, rules by unfinished last segment]. Host labels lead from the root,
    last label first; an empty child key leads on to the path segments."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.root = [{}, None, {}]
        for rule, verdict in rules:
            host, path = split_rule(rule)
            node = self.root
            for label in reversed(host.split(".")):
                node = node[0].setdefault((label,), [{}, None, {}, set()])
            found = (len(rule), len(host), verdict == "block", rule, verdict)
            if path:
                *folders, last = path.split("/")[1:]
                for folder in folders:
                    node = node[0].setdefault(folder, [{}, None, {}, set()])
                node[2][last] = max(found, node[2].get(last, found))
                node[3].add(len(last))
            else:
                node[1] = max(found, node[1] or found)

    def match(self, host: str, path: str):
        """(rule, verdict) of the longest rule that fits, or None."""
        best, node, segments = None, self.root, path.split("/")[1:]
        for label in reversed(host.split(".")):
            node = node[0].get((label,))
            if node is None:
                break
            if node[1] and (best is None or node[1] > best):
                best = node[1]
            folder = node
            for segment in segments:
                for n in folder[3]:  # only lengths that rules have: a long segment costs no more than a short one
                    found = folder[2].get(segment[:n]) if n <= len(segment) else None
                    if found and (best is None or found > best):
                        best = found
                folder = folder[0].get(segment)
                if folder is None:
                    break
        return best and best[3:]


def _by_trie(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    trie = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.arrow_udf("struct<rule: string, verdict: string>")
    def judge(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for hosts, paths in batches:
            found = [trie.value.match(h, p) or (None, None) for h, p in zip(hosts.to_pylist(), paths.to_pylist())]
            yield pa.StructArray.from_arrays(
                [pa.array([f[k] for f in found], pa.string()) for k in (0, 1)], ["rule", "verdict"])
    return pages.withColumn("_found", judge("_host", "_path"))


def _by_join(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """For distinct addresses: every host suffix with every folder prefix meets the rules of that folder."""
    address = pages.select("_host", "_path").distinct()
    labels, parts = F.split("_host", r"\."), F.split("_path", "/")
    spread = (address
              .select("_host", "_path", parts.alias("parts"), labels.alias("labels"),
                      F.explode(F.sequence(F.lit(1), F.size(labels))).alias("i"))
              .select("_host", "_path", "parts", F.array_join(F.slice("labels", F.col("i"), F.size("labels")), ".").alias("h"),
                      F.explode(F.sequence(F.lit(0), F.size("parts") - 1)).alias("j"))
              .select("_host", "_path", "h", F.concat(F.array_join(F.slice("parts", F.lit(1), F.col("j")), "/"),
                                                     F.when(F.col("j") > 0, "/").otherwise("")).alias("folder")))
    rule = F.col("rule")
    host = F.translate(F.substring_index(rule, "/", 1), _UPPER, _LOWER)
    path = F.substr(rule, F.length(host) + 1)
    last = F.element_at(F.split(path, "/"), -1)
    listed = rules.select(
        "rule", "verdict", host.alias("h"), path.alias("p"),
        F.substr(path, F.lit(1), F.length(path) - F.length(last)).alias("folder"))
    order = F.struct(F.length("rule"), F.length("r.h"), (F.col("verdict") == "block").alias("b"), "rule", "verdict")
    best = (spread.alias("s").join(listed.alias("r"), ["h", "folder"]).where(F.col("_path").startswith(F.col("p")))
            .groupBy("_host", "_path").agg(F.max(order).alias("top")))
    found = F.when(F.col("top").isNotNull(), F.struct(F.col("top.rule"), F.col("top.verdict")))
    return pages.join(best, ["_host", "_path"], "left").withColumn("_found", found)


def judge_urls(pages: DataFrame, rules, url_col: str = "url", default: str = "allow",
               max_trie_chars: int = MAX_TRIE_CHARS) -> DataFrame:
    """All columns of ``pages`` and ``host``, ``path``, ``rule``, ``verdict`` (which replace columns of those names).

    ``rules``: pairs or a frame of ``rule`` (host and path, such as ``example.net/en/``; without a slash every
    path) and ``verdict`` (``block`` or ``allow``). A rule fits its host and the hosts below it, if the path
    starts with the rule's path. The longest text wins, then the longer host; between equal rules ``block``.
    Addresses that no rule fits, empty ones, null and those without ``://`` have a null rule and ``default``.
    Rows, repeated or not, are judged one by one; an empty table or list gives no row or only defaults.
    """
    spark = pages.sparkSession
    outputs = {"host", "path", "rule", "verdict"}
    host, path = split_url(F.col(url_col))
    kept = [F.col(f"_row.`{c}`") for c in pages.columns if c.lower() not in outputs]
    rows = pages.select(F.struct("*").alias("_row"), host.alias("_host"), path.alias("_path"))
    if not isinstance(rules, DataFrame):
        size = sum(len(r) for r, _ in rules)
        if size > max_trie_chars:
            rules = spark.createDataFrame(list(rules), "rule string, verdict string")
    else:
        rules = rules.where("rule is not null").select("rule", "verdict")
        size = rules.agg(F.coalesce(F.sum(F.length("rule")), F.lit(0))).first()[0]
        if size <= max_trie_chars:
            rules = [tuple(r) for r in rules.collect()]
    judged = _by_join(rows, rules) if isinstance(rules, DataFrame) else _by_trie(rows, list(rules))
    return judged.select(*kept, F.col("_host").alias("host"), F.col("_path").alias("path"),
                         F.col("_found.rule").alias("rule"),
                         F.coalesce("_found.verdict", F.lit(default)).alias("verdict"))
