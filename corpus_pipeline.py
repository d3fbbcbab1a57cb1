"""Cleans the documents table for training: five stages, each on what the one before kept.

Toxic documents go; of each group of similar documents one stays; passages that an earlier
document has are cut out; documents with benchmark items go; the rest is encoded. Every
stage reads the written table of its predecessor, and all but the last return the columns
of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import decontaminate, ngram_join, pieces, substring_dedup, toxicity
from ledgerlens.llm.common import read, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Trained and iterative stages have no SQL; tests hold run() against plain versions.
ORACLE_SQL = None
#: Near copies share four fifths of their five-word sequences; op1's query has its own values.
ALIKE = {"n": 5, "num": 80, "den": 100}


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity model calls toxic."""
    scored = toxicity.scores_of_texts(docs, read(spark, sf_dir, "labels"), threshold=0.3)
    return scored.filter("predicted = 0").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of similar documents the row with the smallest doc_id.

    Rows without an id cannot be named by a group and stay; of rows that repeat an id all
    that are the smallest of their group stay.
    """
    classes = ngram_join.jaccard_components(docs, **ALIKE, keyed=True)
    dropped = classes.filter("component_id < doc_id").select("doc_id", "node").distinct()
    rows = ngram_join.with_nodes(docs.select(*COLUMNS), ALIKE["n"])
    return rows.join(dropped, ["doc_id", "node"], "left_anti").select(*COLUMNS)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 13 words or more that an earlier document has; other texts stay as they are."""
    out = substring_dedup.substring_dedup(docs.select(*COLUMNS))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return out.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that have a benchmark item, up to a twentieth of edits."""
    found = decontaminate.benchmark_hits(docs.select(*COLUMNS), read(spark, sf_dir, "benchmark"))
    return found.filter(F.size("hits") == 0).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with the digest of the text that they decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    tokens = pieces.encode_pieces(docs.select(*COLUMNS), model)
    return pieces.decode_pieces(tokens, model).select(
        "doc_id",
        "lang",
        "source",
        F.size("token_ids").alias("n_tokens"),
        "token_ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("substring_dedup", without_repeated_passages),
    ("benchmark_decontamination", without_benchmark),
    ("sentence_pieces", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
