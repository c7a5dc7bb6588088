"""Record rules as one array of violations, and check constraints (VAL-01..03, VAL-11, SET-01..06)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from strataflow.functions.record_rules import column_rules


def violations(*rules: tuple[str, Column]) -> Column:
    """Messages of the rules that are not true, in order; a null verdict counts as broken."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(message)) for message, ok in rules]))


def first_violation(found: Column) -> Column:
    return F.try_element_at(found, F.lit(1))


def validate_records(df: DataFrame, provenance: bool = True) -> DataFrame:
    """Typed records with all ``violations`` and the ``first_error``, null if there is none."""
    out = df.withColumn("violations", violations(*column_rules(provenance)))
    return out.withColumn("first_error", first_violation(F.col("violations")))


def with_provenance(df: DataFrame, model: str, prompt_version: str, executed_at: str) -> DataFrame:
    """Semantic records with the three provenance fields, to be validated again (VAL-03)."""
    return df.withColumns({"model": F.lit(model), "prompt_version": F.lit(prompt_version), "screened_at": F.lit(executed_at)})


def broken_constraints(df: DataFrame, spec: dict[str, Column], keys: Sequence[str]) -> DataFrame:
    """Rows that break a check, with the names of the broken ones (SQL semantics: a null verdict passes)."""
    bad = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in spec.items()]))
    return df.select(*keys, bad.alias("broken")).filter(F.size("broken") > 0)


def same_set(a: DataFrame, b: DataFrame) -> bool:
    """Whether two frames hold the same distinct rows (SET-02)."""
    return not a.distinct().exceptAll(b.distinct()).limit(1).count() and not b.distinct().exceptAll(a.distinct()).limit(1).count()


def disjoint(a: DataFrame, b: DataFrame) -> bool:
    """Whether two frames share no row (SET-05)."""
    return not a.intersect(b).limit(1).count()


def positional_check(lines: DataFrame, expected: DataFrame) -> DataFrame:
    """Output lines against the ordered keys they should answer (JOIN-07): missing, extra, repeated or out of place."""
    seen = lines.groupBy("pmid").agg(F.count("*").alias("times"))
    joined = expected.select("ordinal", F.col("pmid").alias("wanted")).join(lines.select("ordinal", "pmid"), "ordinal", "full").join(seen, "pmid", "left")
    error = F.when(F.col("wanted").isNull(), "extra line").when(F.col("pmid").isNull(), "missing line").when(F.col("times") > 1, "duplicate id").when(F.col("pmid") != F.col("wanted"), "unexpected id or order")
    return joined.select("ordinal", "wanted", "pmid", error.alias("error")).filter("error is not null")


def file_problems(ledger: DataFrame, path_col: str, sha_col: str, found_col: str = "found_sha256") -> DataFrame:
    """Rows of a ledger whose file is ``missing``, ``changed``, or ``given twice``: named by another row too (VAL-08).

    A path's rows are counted by partial aggregates and joined back, so that one path in many rows fills no task.
    """
    twice = ledger.groupBy(path_col).agg(F.count("*").alias("__n")).filter("__n > 1").select(path_col, F.lit(True).alias("__twice"))
    problem = F.when(F.col(found_col).isNull(), "missing").when(~F.col(found_col).eqNullSafe(F.col(sha_col)), "changed").when(F.col("__twice"), "given twice")
    return ledger.join(twice, path_col, "left").withColumn("problem", problem).filter("problem is not null").select(*ledger.columns, "problem")
