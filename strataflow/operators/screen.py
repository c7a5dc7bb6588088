"""Rule screening: flags records, never drops one (FN-05..07, VAL-10, AGG-05)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from strataflow.functions.scalars import casefold, matched
from strataflow.functions.vocabularies import CANCER_RULES, NON_ORIGINAL_TYPES, OMICS_RULES, ORIGINAL_OR_UNCLEAR_TYPES


@dataclass(frozen=True)
class RulePack:
    """Versioned patterns of two groups."""

    version: str
    cancer: tuple[str, ...] = CANCER_RULES
    omics: tuple[str, ...] = OMICS_RULES

    def __post_init__(self) -> None:
        if not self.cancer or not self.omics:
            raise ValueError("both rule groups need patterns")


def has_type(types: Column, wanted: Sequence[str]) -> Column:
    return F.arrays_overlap(F.transform(F.coalesce(types, F.array().cast("array<string>")), casefold), F.array(*map(F.lit, wanted)))


def screen(df: DataFrame, rules: RulePack, screened_at: str, key: str = "pmid", carry: Sequence[str] = ()) -> DataFrame:
    """Screen row of each record in one scan: terms hit in title, abstract and headings, and the flags; and the columns named in ``carry``."""
    text = F.concat_ws("\n", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit("")), F.array_join(F.coalesce("mesh_terms", F.array().cast("array<string>")), "\n"))
    terms = df.select(key, *carry, F.col("article_types").alias("__types"), matched(rules.cancer, text).alias("cancer_terms"), matched(rules.omics, text).alias("omics_terms"))
    hits = terms.select(key, *carry, F.lit(rules.version).alias("rules_version"), (F.size("cancer_terms") > 0).alias("cancer_hit"), (F.size("omics_terms") > 0).alias("omics_hit"), has_type(F.col("__types"), NON_ORIGINAL_TYPES).alias("obvious_non_original_type"), "cancer_terms", "omics_terms")
    return hits.select("*", (F.col("cancer_hit") & F.col("omics_hit") & ~F.col("obvious_non_original_type")).alias("candidate_priority"), F.lit(screened_at).alias("screened_at"))


def screen_summary(screens: DataFrame) -> DataFrame:
    """Counts; what no rule matched is not excluded."""
    hit, non = F.count_if("candidate_priority"), F.count_if("obvious_non_original_type")
    return screens.agg(F.count("*").alias("screened"), hit.alias("candidate_priority"), non.alias("obvious_non_original_type"), (F.count("*") - hit).alias("unmatched_not_excluded"))


def stratum(candidate_priority: Column, types: Column) -> Column:
    """Sampling stratum; null for records outside the frame (FN-07)."""
    empty = F.size(F.coalesce(types, F.array().cast("array<string>"))) == 0
    return F.when(candidate_priority, "candidate_priority").when(has_type(types, NON_ORIGINAL_TYPES), "obvious_non_original").when(empty | has_type(types, ORIGINAL_OR_UNCLEAR_TYPES), "non_priority_original_or_unclear")
