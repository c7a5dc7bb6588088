"""Explicit schemas of the engine's tables, and their checks. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from strataflow.functions.vocabularies import FULL_TEXT_STATUSES, RECORD_ENUMS, SI_STATUSES, STATUSES

AUTHOR = "struct<last:string,fore:string,initials:string,orcid:string,collective:string>"

RECORD = f"pmid string, doi string, source_journal_title string, publication_date string, publication_date_precision string, publication_year int, title string, abstract string, article_types array<string>, authors array<{AUTHOR}>, mesh_terms array<string>"

SEMANTIC = "pmid string, disease string, study string, primary_contribution string, data_modalities array<string>, computational_centrality int, new_experimental_data string, public_data_reuse string, relevance string, confidence double, rationale string"

TABLES: dict[str, str] = {
    "schema_meta": "key string, value string",
    "enumeration_runs": "run_id string, journal_key string, journal_title string, registry_version string, query string, start_date date, end_date date, expected_count bigint, fetched_count bigint, unique_count bigint, status string, error string, started_at string, completed_at string",
    "articles": f"{RECORD.replace('source_journal_title', 'journal_key string, source_journal_title')}, pubmed_url string, first_seen_run_id string, last_seen_run_id string, source_updated_at string",
    "enumeration_membership": "run_id string, pmid string, ordinal bigint",
    "enumeration_batches": "run_id string, retstart bigint, record_count bigint, raw_xml_path string, byte_size bigint, sha256 string",
    "deterministic_screens": "pmid string, rules_version string, cancer_hit boolean, omics_hit boolean, candidate_priority boolean, cancer_terms array<string>, omics_terms array<string>, screened_at string",
    "llm_screens": f"id bigint, {SEMANTIC}, model string, prompt_version string, screened_at string, imported_at string",
    "audit_samples": "sample_id string, pmid string, source_relevance string, fraction double, seed string, hash_rank string, sampled_at string",
    "human_reviews": "id bigint, pmid string, decision string, computational_story_central boolean, reason string, reviewer string, reviewed_at string",
    "historical_backfills": "backfill_id string, registry_version string, start_date date, end_date date, software_revision string, journal_count int, status string, started_at string, completed_at string",
    "historical_backfill_journals": "backfill_id string, journal_key string, enumeration_run_id string, status string, attempt_count int, error string, started_at string, completed_at string",
    "historical_backfill_slices": "backfill_id string, journal_key string, slice_start date, slice_end date, planned_count bigint, enumeration_run_id string, status string, attempt_count int, error string, started_at string, completed_at string",
    "backfill_coverage_checks": "backfill_id string, journal_key string, scope string, period_start date, period_end date, query string, expected_count bigint, observed_count bigint, status string, checked_at string",
    "calibration_samples": "calibration_id string, seed string, prompt_version string, created_at string",
    "calibration_sample_items": "calibration_id string, pmid string, stratum string, population_size bigint, hash_rank string, selected_at string",
    "manual_web_attempts": "batch_id string, attempt int, calibration_id string, route string, execution_mode string, model_label string, operator string, prompt_version string, software_revision string, input_path string, input_sha256 string, output_path string, output_sha256 string, record_count bigint, wrapper_version string, wrapper_sha256 string, fresh_chat_confirmed boolean, temperature string, max_tokens string, status string, error string, created_at string, executed_at string, validated_at string, imported_at string",
    "manual_web_attempt_items": "batch_id string, attempt int, pmid string, ordinal int, llm_screen_id bigint",
}

KEYS: dict[str, tuple[str, ...]] = {
    "schema_meta": ("key",), "enumeration_runs": ("run_id",), "articles": ("pmid",), "enumeration_membership": ("run_id", "pmid"),
    "enumeration_batches": ("run_id", "retstart"), "deterministic_screens": ("pmid", "rules_version"),
    "llm_screens": ("pmid", "model", "prompt_version", "screened_at"), "audit_samples": ("sample_id", "pmid"), "human_reviews": ("id",),
    "historical_backfills": ("backfill_id",), "historical_backfill_journals": ("backfill_id", "journal_key"),
    "historical_backfill_slices": ("backfill_id", "journal_key", "slice_start", "slice_end"),
    "backfill_coverage_checks": ("backfill_id", "journal_key", "scope", "period_start", "period_end"),
    "calibration_samples": ("calibration_id",), "calibration_sample_items": ("calibration_id", "pmid"),
    "manual_web_attempts": ("batch_id", "attempt"), "manual_web_attempt_items": ("batch_id", "attempt", "pmid"),
}

#: Columns that refer to rows of another table.
REFERENCES: dict[str, tuple[tuple[tuple[str, ...], str], ...]] = {
    "enumeration_membership": ((("run_id",), "enumeration_runs"), (("pmid",), "articles")), "enumeration_batches": ((("run_id",), "enumeration_runs"),),
    "deterministic_screens": ((("pmid",), "articles"),), "llm_screens": ((("pmid",), "articles"),), "audit_samples": ((("pmid",), "articles"),),
    "historical_backfill_journals": ((("backfill_id",), "historical_backfills"),), "historical_backfill_slices": ((("backfill_id", "journal_key"), "historical_backfill_journals"),),
    "backfill_coverage_checks": ((("backfill_id", "journal_key"), "historical_backfill_journals"),),
    "calibration_sample_items": ((("calibration_id",), "calibration_samples"), (("pmid",), "articles")), "manual_web_attempts": ((("calibration_id",), "calibration_samples"),),
    "manual_web_attempt_items": ((("batch_id", "attempt"), "manual_web_attempts"), (("pmid",), "articles")),
}

#: What columns were called in older stores.
RENAMED: dict[str, dict[str, str]] = {"manual_web_attempts": {"provider_route": "route", "model_display_name": "model_label", "maximum_output_tokens": "max_tokens", "completed_at": "validated_at"}}

#: A row of the manifest of full texts.
FULL_TEXT_MANIFEST = "pmid string, doi string, status string, source_url string, local_path string, bytes bigint, sha256 string, format_verified boolean, si_status string, checked_at string, notes string"


def checks(table: str) -> dict[str, Column]:
    """Named check constraints of a table."""
    out: dict[str, Column] = {}
    if table == "llm_screens":
        out |= {name: F.col(name).isin(*values) for name, values in RECORD_ENUMS.items()}
        out |= {"computational_centrality": F.col("computational_centrality").between(0, 3), "confidence": F.col("confidence").between(0, 1)}
    if table in ("enumeration_runs", "historical_backfill_journals", "historical_backfill_slices", "historical_backfills"):
        out["status"] = F.col("status").isin(*STATUSES)
    if table == "backfill_coverage_checks":
        out |= {"scope": F.col("scope").isin("full_window", "annual"), "status": F.col("status").isin("match", "discrepancy")}
    if table == "audit_samples":
        out["fraction"] = (F.col("fraction") > 0) & (F.col("fraction") <= 1)
    if table == "human_reviews":
        out["decision"] = F.col("decision").isin("INCLUDE", "EXCLUDE", "UNCLEAR")
    if table == "manual_web_attempts":
        out |= {"status": F.col("status").isin("prepared", "valid", "failed"), "execution_mode": F.col("execution_mode").isin("manual", "automated_browser")}
    if table == "full_text_manifest":
        out |= {"pmid": F.col("pmid").rlike(r"^[0-9]+\z"), "status": F.col("status").isin(*FULL_TEXT_STATUSES), "bytes": F.col("bytes") >= 0, "sha256": F.col("sha256").rlike(r"^[a-f0-9]{64}\z"), "si_status": F.col("si_status").isin(*SI_STATUSES)}
    return out
