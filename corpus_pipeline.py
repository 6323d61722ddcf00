"""A corpus pipeline over ``documents``: each stage reads what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import bpe, decontam, lines, neardup, quality
from fareloom.llm.common import land

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (predicted 0) go. It learns from the labelled ones among
    ``docs`` in its training fold; a null text or one of no words gets the score of the constant. Repeated rows are judged
    alike; an empty table stays empty. Columns of ``docs`` that are called as the classifier's own come out as they went in."""
    own = {c: f"docs_{c}" for c in docs.columns if c.lower() in ("score", "predicted", "held_out")}
    scored = quality.classify(docs.withColumnsRenamed(own), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 1").select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that repeat earlier ones are cut out; ``n_chars`` follows the text. All rows stay, those with null or
    empty texts as they are; rows that agree in id and text are cut alike. An empty table stays empty."""
    cut = lines.dedup_lines(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id.

    A row without an id cannot be named by a group and stays; rows that share an id, and so repeated rows, go or stay
    together. Null and empty texts are alike and form one group. An empty table stays empty.
    """
    found = neardup.near_duplicates(docs, shingle=4, max_bits=4)
    gone = found.where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item is found go. Null and empty texts hold none and stay; repeated rows are judged
    alike. Without documents or items nothing changes."""
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of each document, and the digest of the text they decode to: one row per row. Null and empty texts have no
    token and the digest of the empty text. An empty table gives an empty result."""
    out = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), decoded=True, keep=("lang", "source", "n_chars"))
    return out.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids",
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_quality),
    ("line_dedup", cut_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("bpe_encode_decode", tokenize),
]

#: The stages train, hash and align; SQL cannot express them. tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. The result of each is landed as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = land(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
