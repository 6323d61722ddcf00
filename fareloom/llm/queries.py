"""The numbered operators applied to the whole of their tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ..catalog.mapping import table
from . import bpe, conversations, decontam, licenses, lines, neardup, negatives, quality, secrets, sharding, signatures, topk, urls
from .registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]


@query("op1_hypergeometric_sharding")
def op1(spark, sf_dir):
    """Law ``rows``: counts at most one apart. Nothing is kept together, copies of a text least of all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.shuffle_into_shards(docs, 8, seed=20)
    return out.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                      F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"), F.lit("rows").alias("law"),
                      "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query("op2_license_scan")
def op2(spark, sf_dir):
    return licenses.find_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op3_benchmark_decontamination")
def op3(spark, sf_dir):
    """The default similarity of 0.8: at most a fifth of an item's words are edited."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.find_leaks(docs, table(spark, sf_dir, "benchmark"))


@query("op4_bpe_encode_decode")
def op4(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    out = bpe.encode(table(spark, sf_dir, "documents"), path, decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op5_simhash_near_dedup")
def op5(spark, sf_dir):
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op6_exact_top_k", """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
        WHERE q.vec_id % 100 = 0),
    ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
        FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""")
def op6(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


@query("op7_quality_classifier")
def op7(spark, sf_dir):
    out = quality.classify(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


@query("op8_line_dedup")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "text", "removed_lines", "removed_words")


URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@query("op9_url_filter", f"""
    WITH parts AS (
        SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
    hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM parts),
    urls AS (
        SELECT page_id, translate(raw, '{urls._UPPER}', '{urls._LOWER}') AS host,
               regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
        FROM hosts),
    rules(rule, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
    split AS (SELECT rule, verdict, substr(rule, 1, instr(rule, '/') - 1) AS h, substr(rule, instr(rule, '/')) AS p
              FROM rules)
    SELECT u.page_id, u.host, u.path, arg_max(s.rule, length(s.rule)) AS rule,
           coalesce(arg_max(s.verdict, length(s.rule)), 'allow') AS verdict
    FROM urls u LEFT JOIN split s
      ON (u.host = s.h OR ends_with(u.host, '.' || s.h)) AND starts_with(u.path, s.p)
    GROUP BY u.page_id, u.host, u.path""")
def op9(spark, sf_dir):
    out = urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


@query("op10_secret_scan")
def op10(spark, sf_dir):
    """The test tables have no labelled findings: their forms and the names they are assigned to stand for them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return secrets.find_secrets(docs, secrets.labels_by_form(), path_col="source")


def _head_length(conv_id):
    return F.crc32(conv_id.cast("string")) % 9


@query("op11_conversation_prefix_trie", """
    WITH t AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
        FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (
        SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
                   string_split(conv_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
               lambda a, b: xor(xor(a, b) >> 1, 3988292384::BIGINT * (xor(a, b) & 1))), 4294967295::BIGINT) % 9 AS h
        FROM (SELECT DISTINCT conv_id FROM t)),
    rebuilt AS (
        SELECT i.conv_id, 0 AS own, b.pos, b.role, b.text FROM ids i JOIN t b ON b.conv_id = i.base AND b.pos <= i.h
        UNION ALL
        SELECT i.conv_id, 1, t.pos, t.role, t.text FROM ids i JOIN t ON t.conv_id = i.conv_id AND t.pos > i.h),
    paths AS (
        SELECT conv_id, row_number() OVER w AS depth, strlen(text) AS size,
               string_agg(sha256(length(role)::VARCHAR || ':' || role || text), '') OVER w AS path
        FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos ROWS UNBOUNDED PRECEDING)
        UNION ALL SELECT conv_id, 0, 0, '' FROM ids),
    nodes AS (
        SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved
        FROM paths GROUP BY depth, path),
    kids AS (SELECT depth - 1 AS depth, left(path, 64 * (depth - 1)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
    full_nodes AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (depth, path)),
    above AS (SELECT left(path, 64 * up) AS path, up AS depth, n_children, saved
              FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM full_nodes)),
    totals AS (SELECT depth, path, count_if(n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY 1, 2),
    ends AS (SELECT depth, path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
             FROM (SELECT conv_id, max(depth) AS depth, arg_max(path, depth) AS path FROM paths GROUP BY 1) GROUP BY 1, 2)
    SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
           n.n_children::BIGINT AS n_children, t.n_leaves::BIGINT AS n_leaves, t.saved_tokens::BIGINT AS saved_tokens,
           sha256(coalesce(e.ids, '')) AS ends_sha256
    FROM full_nodes n JOIN totals t USING (depth, path) LEFT JOIN ends e USING (depth, path)
    LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = left(n.path, 64 * (n.depth - 1))""")
def op11(spark, sf_dir):
    """Every conversation is rebuilt from the head of the first of its five and its own rest; then the trie of all."""
    placed = conversations.place_turns(table(spark, sf_dir, "conversations"))
    members = placed.select("conv_id").distinct()
    own = placed.where(F.col("place") > _head_length(F.col("conv_id"))).withColumn("place", F.col("place") + 8)
    # A head has 8 turns at most and goes to 9 conversations at most.
    heirs = F.filter(F.transform(F.sequence(F.lit(-4).cast("long"), F.lit(4).cast("long")), lambda i: F.try_add("conv_id", i)),
                     lambda c: c - c % 5 == F.col("conv_id"))
    heads = (placed.where("place <= 8 and conv_id % 5 = 0").withColumn("conv_id", F.explode(heirs))
             .where(F.col("place") <= _head_length(F.col("conv_id"))).join(members, "conv_id", "left_semi"))
    return conversations.prefix_trie(heads.unionByName(own), members)


@query("op12_hard_negatives", """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    scored AS (
        SELECT a.vec_id AS anchor_id, o.vec_id AS vec_id, a.label = o.label AS same,
               CAST(list_dot_product(a.e, o.e) AS BIGINT) AS score
        FROM v a JOIN v o ON a.vec_id <> o.vec_id AND len(a.e) = len(o.e)
        WHERE a.vec_id % 50 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    ranked AS (
        SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
        FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
         AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3""")
def op12(spark, sf_dir):
    vec_id, label = F.col("vec_id"), F.col("label")
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return negatives.hard_negatives(rows, vec_id % 50 == 0)


@query("op13_document_fingerprints")
def op13(spark, sf_dir):
    return signatures.fingerprint_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
