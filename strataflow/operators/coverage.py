"""Completeness by distinct union, not by added counts (REC-01..04, AGG-01..06, AGG-10)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from strataflow.functions.scalars import coverage_status


def union_count(slices: DataFrame, membership: DataFrame, by: Sequence[str] = (), key: str = "pmid", articles: DataFrame | None = None, year: int | None = None) -> DataFrame:
    """Distinct members of complete slices, exact (AGG-01); with ``year``, only those that ``articles`` date to it (FLT-02)."""
    done = slices.filter("status = 'complete'").select(*by, F.col("enumeration_run_id").alias("run_id"))
    members = done.join(membership, "run_id")
    if year is not None:
        members = members.join(articles.filter(F.col("publication_year") == year).select(key), key, "left_semi")
    return members.groupBy(*by).agg(F.countDistinct(key).alias("observed_count"))


def reconcile(expected: DataFrame, observed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected and observed counts of each key with their status; a side without a row counts 0 (REC-02)."""
    joined = expected.join(observed, list(keys), "full")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("expected_count", "observed_count")]
    return joined.select(*keys, *counts).withColumn("status", coverage_status(F.col("expected_count"), F.col("observed_count")))


def status_counts(df: DataFrame, statuses: Sequence[str], status: str = "status") -> DataFrame:
    """One row: how many rows have each status, 0 where none, also on empty input (AGG-02)."""
    return df.agg(*[F.count_if(F.col(status) == s).alias(s) for s in statuses])


def check_counts(checks: DataFrame, scope: str) -> DataFrame:
    """Checks of a scope and how many are discrepancies (AGG-03)."""
    return checks.filter(F.col("scope") == scope).agg(F.count("*").alias(f"{scope}_checks"), F.count_if(F.col("status") == "discrepancy").alias(f"{scope}_discrepancies"))


def backfill_summary(run: DataFrame, journals: DataFrame, slices: DataFrame, membership: DataFrame, checks: DataFrame) -> DataFrame:
    """One row on a backfill: its parameters, journals by state, distinct records and checks (REC-03).

    Cross joins are of one-row aggregates only.
    """
    if not run.limit(1).count():
        raise ValueError("unknown backfill")
    states = status_counts(journals, ("complete", "failed", "pending", "running")).select(F.col("complete").alias("completed_journals"), F.col("failed").alias("failed_journals"), (F.col("pending") + F.col("running")).alias("pending_journals"))
    seen = union_count(slices, membership).withColumnRenamed("observed_count", "unique_articles")
    out = run
    for part in (states, seen, check_counts(checks, "annual"), check_counts(checks, "full_window")):
        out = out.crossJoin(F.broadcast(part))
    return out


def run_gate(batches: DataFrame, membership: DataFrame, expected: DataFrame) -> DataFrame:
    """Per run: reported, fetched and distinct counts, and ``complete`` only if all agree (PLN-04, AGG-06)."""
    fetched = batches.groupBy("run_id").agg(F.sum("record_count").alias("fetched_count"))
    unique = membership.groupBy("run_id").agg(F.countDistinct("pmid").alias("unique_count"))
    joined = expected.join(fetched, "run_id", "left").join(unique, "run_id", "left").na.fill(0, ["fetched_count", "unique_count"])
    same = (F.col("expected_count") == F.col("fetched_count")) & (F.col("fetched_count") == F.col("unique_count"))
    return joined.withColumn("status", F.when(same, "complete").otherwise("failed"))


def registry_check(registry: DataFrame, hits: DataFrame, key: str = "key") -> DataFrame:
    """Every registry entry with its hit count, 0 where none, and whether it is valid (REC-04, PRJ-05)."""
    counts = hits.groupBy(key).agg(F.count("*").alias("hit_count"))
    return registry.join(counts, key, "left").withColumn("hit_count", F.coalesce("hit_count", F.lit(0))).withColumn("valid", F.col("hit_count") > 0)


def report_rows(journals: DataFrame, checks: DataFrame, slices: DataFrame, key: str = "journal_key") -> DataFrame:
    """A row per journal: its state, and ``annual_coverage``, ``full_window_coverage`` and ``slices`` as ordered arrays of structs (AGG-10).

    The four sections are dealt by key once and gathered by partial aggregates; what a journal gathers is bounded by its
    years and slices. A journal that only one section has still has a row, with empty arrays for the others.
    """
    sections = {"annual_coverage": (checks.filter("scope = 'annual'").drop("scope"), "period_start"), "full_window_coverage": (checks.filter("scope = 'full_window'").drop("scope"), "period_start"), "slices": (slices, "slice_start")}
    state = F.struct(*[c for c in journals.columns if c != key])
    parts = [journals.select(key, state.alias("journal"))]
    for name, (df, order) in sections.items():
        rest = [c for c in df.columns if c not in (key, order)]
        parts.append(df.select(key, F.struct(order, *rest).alias(name)))
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return together.groupBy(key).agg(F.first("journal", ignorenulls=True).alias("journal"), *[F.array_sort(F.collect_list(name)).alias(name) for name in sections])


def coverage_report(summary: DataFrame, journals: DataFrame, checks: DataFrame, slices: DataFrame) -> dict:
    """The report object (SNK-04): the summary, and four ordered lists out of the rows of ``report_rows``, which come one after the other."""
    out = summary.first().asDict() | {"journals": [], "annual_coverage": [], "full_window_coverage": [], "slices": []}
    for row in report_rows(journals, checks, slices).orderBy("journal_key").toLocalIterator(prefetchPartitions=True):
        one = row.asDict(recursive=True)
        if one["journal"] is not None:
            out["journals"].append({"journal_key": one["journal_key"], **one["journal"]})
        for section in ("annual_coverage", "full_window_coverage", "slices"):
            out[section] += [{"journal_key": one["journal_key"], **r} for r in one[section]]
    return out
