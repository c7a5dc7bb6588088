"""Transitions of states checked over a whole log (UPS-11)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from strataflow.operators.scratch import discard, stored


def with_previous(log: DataFrame, keys: Sequence[str], order: Sequence[str], state: str) -> DataFrame:
    """Each row with ``previous``, the state of the row before it of its key, and ``is_first``; ``order`` has to name a total order in a key.

    Rows are dealt by ranges of key and order, so that a key with a third of the log spans many tasks. In a range the row
    before is a lag; the first row of a range looks at the last row of the range before it, of which there is one a range.
    """
    by = [*keys, *order]
    here = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(state).alias("state"))
    table = stored(log.repartitionByRange(*by).withColumn("__range", F.spark_partition_id()), "ranges")
    last = table.groupBy("__range").agg(F.max_by(here, F.struct(*by)).alias("__last"))
    edges = last.select("__range", F.lag("__last").over(Window.orderBy("__range")).alias("__edge"))  # a row a range: as many as shuffle partitions
    rows = table.withColumn("__lag", F.lag(here).over(Window.partitionBy("__range").orderBy(*by))).join(F.broadcast(edges), "__range")
    before = F.coalesce("__lag", "__edge")
    same = reduce(lambda a, b: a & b, (before[f"k{i}"].eqNullSafe(F.col(k)) for i, k in enumerate(keys)), before.isNotNull())
    out = stored(rows.select(*log.columns, F.when(same, before["state"]).alias("previous"), (~same).alias("is_first")), "previous")
    discard(table)
    return out


def illegal_transitions(log: DataFrame, keys: Sequence[str], order: Sequence[str], state: str, allowed: Iterable[tuple[str | None, str]]) -> DataFrame:
    """Rows of the log whose state may not follow that of the row before, which is given as ``previous``.

    ``allowed`` lists the pairs of an automaton; one that begins with None says how a key may begin. A null state may
    follow nothing, and nothing may follow it. The guard of a finished attempt is such an automaton: what is valid or failed
    has no successor.
    """
    pairs = list(allowed)
    follows = reduce(lambda a, b: a | b, (F.col("previous").eqNullSafe(F.lit(x)) & ~F.col("is_first") & (F.col(state) == y) for x, y in pairs if x is not None), F.lit(False))
    begins = F.col("is_first") & F.col(state).isin([y for x, y in pairs if x is None])
    return with_previous(log, keys, order, state).filter(~F.coalesce(follows | begins, F.lit(False))).drop("is_first")
