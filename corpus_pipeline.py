"""The corpus pipeline: quality rules, near-duplicate removal, redaction, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
back as the next one's ``docs``.  All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrace.llm import jaccard, packing, pii, quality
from vectrace.llm.common import delete_folder, shared_folder, table

#: Near duplicates share 80 % of their five-word shingles.
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, their columns unchanged.

    Null and empty texts have no words and go; a null id or a repeated row is judged by its text like any other.
    """
    return quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least id of every group of linked documents, columns unchanged.

    Rows with a null id are linked with nothing and stay.  Rows of one id and one set of shingles are one;
    different texts under one id are decided each by itself.  Empty texts link with nothing.
    """
    return jaccard.keep_one(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the new text.  Every row stays; a null text stays null."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length bucket, batch and slot of every document; null and empty texts have no tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", drop_low_quality),
    ("ngram_jaccard", drop_near_copies),
    ("pii", redact_pii),
    ("packing", pack_batches),
]

#: The boosted trees and the bucket bounds cannot be written in SQL; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read back.

    A stage's rows are deleted once the next one's are written.  An empty table goes through and gives
    no rows.
    """
    folder, before = shared_folder(spark, "pipeline"), None
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{name}")
        if before:
            delete_folder(spark, f"{folder}/{before}")
        before = name
    return docs
