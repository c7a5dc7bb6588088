"""Corpus pipeline: five stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.llm import language_id, quality_classifier
from strataflow.llm.packing import pack_documents
from strataflow.llm.scratch import discard, stored
from strataflow.llm.simhash import keep_first
from strataflow.llm.substring_dedup import dedup_substrings

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the labels of documents at hand, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.keep_good(docs, quality_classifier.learn(docs, labels))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the documents at hand teach."""
    return language_id.keep_identified(docs, language_id.learn(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id in each component of near-duplicates."""
    return keep_first(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the passages that an earlier one has; those that consist of such passages alone go."""
    out = dedup_substrings(docs, carry=("lang", "source"))
    return out.filter(~F.col("changed") | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select("doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row per piece of a document with its place."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("language ID", known_language),
    ("SimHash near-dedup", one_of_each),
    ("substring dedup", without_repeats),
    ("best-fit packing", packed),
]

#: The classifiers, fingerprints and tokenizers of the stages have no SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for k, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"stage{k + 1}")
        discard(before)  # nothing reads the stage before the last any more
    return STAGES[-1][1](spark, docs, sf_dir)
