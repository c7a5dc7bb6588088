"""Latest row of a key, with explicit tie-breaks (WIN-01, WIN-02)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``, which has to name a total order.

    Spark puts a group limit on both sides of the shuffle, so that a hot key sends a row a task.
    Filters on the chosen row belong behind this call: an older row that fits must not win (FLT-06).
    """
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("__rank = 1").drop("__rank")


def latest_by_max(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key with the greatest ``order`` columns, by a partially aggregated maximum instead of a sort."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def with_latest(left: DataFrame, decisions: DataFrame, keys: Sequence[str], order: Sequence[Column], defaults: dict[str, object]) -> DataFrame:
    """Left join with each key's latest decision, nulls of absent ones filled (JOIN-03, PRJ-03).

    The decisions are ranked before the join, so that unmatched left rows stay.
    """
    wanted = latest_by(decisions, keys, order).select(*keys, *defaults)
    joined = left.join(wanted, list(keys), "left")
    return joined.select(*left.columns, *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()])
