"""Table changes as pure functions of snapshots (UPS-01..15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from strataflow.operators.latest import latest_by


class DuplicateKey(ValueError):
    """An append would break a key."""


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: Sequence[str] = ()) -> DataFrame:
    """``target`` with ``source`` rows put in or over it.

    Of several source rows of a key the first in ``order`` counts. All columns are overwritten, nulls
    included, but for ``keys`` and, where the key exists already, ``keep`` (UPS-01, UPS-03, UPS-04, UPS-08).
    """
    new = latest_by(source, keys, order).select(*target.columns).withColumn("__new", F.lit(True))
    old = target.withColumn("__old", F.lit(True))
    joined = old.alias("t").join(new.alias("s"), [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys], "full")
    came, had = F.col("s.__new").isNotNull(), F.col("t.__old").isNotNull()

    def value(c: str) -> Column:
        stays = ~came if c not in keep and c not in keys else had
        return F.when(stays, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c)

    return joined.select(*[value(c) for c in target.columns])


def first_seen(source: DataFrame, keys: Sequence[str], order: Sequence[str], first: Sequence[str]) -> DataFrame:
    """Replay of a log by upserts: ``first`` columns from each key's earliest row, all others from its latest."""
    at = F.struct(*order)
    rest = [c for c in source.columns if c not in keys and c not in first]
    return source.groupBy(*keys).agg(*[F.min_by(c, at).alias(c) for c in first], *[F.max_by(c, at).alias(c) for c in rest])


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``target`` and the source rows with keys it lacks; of several the first in ``order`` (UPS-02, UPS-05..07)."""
    return target.unionByName(inserted(target, source, keys, order))


def inserted(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows that ``insert_ignore`` adds."""
    return latest_by(source, keys, order).join(target.select(*keys), list(keys), "left_anti").select(*target.columns)


def append(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` and all of ``source``; a repeated key raises (UPS-09)."""
    both = target.select(*keys).unionByName(source.select(*keys))
    if both.groupBy(*keys).count().filter("count > 1").limit(1).count():
        raise DuplicateKey(f"repeated key in {', '.join(keys)}")
    return target.unionByName(source.select(*target.columns))


def state_of(log: DataFrame, keys: Sequence[str], order: Sequence[str], status: str = "status", started: str = "running") -> DataFrame:
    """Current state from a log of transitions: last status, number of starts, last time (UPS-10, UPS-11)."""
    at = F.struct(*order)
    return log.groupBy(*keys).agg(F.max_by(status, at).alias("status"), F.count_if(F.col(status) == started).alias("attempt_count"), F.max(order[0]).alias("changed_at"))


def back_reference(items: DataFrame, screens: DataFrame, keys: Sequence[str], reference: str = "id", into: str = "llm_screen_id") -> DataFrame:
    """Items with the id of the screen of their natural key (UPS-12, JOIN-05)."""
    found = screens.select(*keys, F.col(reference).alias("__ref"))
    return items.join(found, list(keys), "left").select(*[F.coalesce("__ref", into).alias(into) if c == into else F.col(c) for c in items.columns])


def migrate(old: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Old rows in a new layout: columns by name and type, absent ones null (UPS-13)."""
    return old.select(*[(F.col(c) if c in old.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])


def orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows without a parent: must be empty (UPS-15, JOIN-06, FLT-07)."""
    return child.join(parent.select(*keys).distinct(), list(keys), "left_anti")
