"""The operators applied to their whole tables, and the SQL that can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.llm import language_id, quality_classifier, quality_rules
from strataflow.llm.alignment import align_documents
from strataflow.llm.byte_bpe import round_trip_digests
from strataflow.llm.fingerprints import compare_with_next
from strataflow.llm.html_extract import extract
from strataflow.llm.lattice import score_documents
from strataflow.llm.packing import pack_documents
from strataflow.llm.simhash import near_duplicates
from strataflow.llm.substring_dedup import dedup_substrings
from strataflow.llm.token_counts import token_counts
from strataflow.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(_table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents")).drop("text")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.learn(docs)).select("doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_table(spark, sf_dir, "pages"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(_table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_classifier.learn(docs, _table(spark, sf_dir, "labels"))
    return quality_classifier.classify(docs, model).select("doc_id", quality_classifier.held_out("doc_id").alias("held_out"), "score", "predicted")


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(_table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_quality_rules": op2_quality_rules,
    "op3_language_id": op3_language_id,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_html_extraction": op7_html_extraction,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_simhash": op9_simhash,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_lm_scoring": op13_lm_scoring,
}

ORACLE_SQL: dict[str, str] = {"op2_quality_rules": quality_rules.ORACLE_SQL}
