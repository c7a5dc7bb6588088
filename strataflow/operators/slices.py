"""Date slices under a source's result limit (PLN-01)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from strataflow.operators.scratch import discard, stored


class SliceTooLarge(ValueError):
    """A single day holds more than the limit."""


def split(start: date, end: date) -> list[tuple[date, date]]:
    middle = start + timedelta(days=(end - start).days // 2)
    return [(start, middle), (middle + timedelta(days=1), end)]


def plan_slices(universe: DataFrame, key: str, day: str, start: date, end: date, most: int) -> DataFrame:
    """Closed intervals of each key that hold at most ``most`` rows, by halving those that hold more.

    The rows are counted per key and day once; what is planned then is that histogram, which is
    bounded by keys * days, level by level for all keys at once: an interval's count is a difference
    of two running sums, so that a level is an equi-join, not a theta join over rows.
    Columns: key, ``slice_start``, ``slice_end``, ``planned_count``. Empty halves are kept.
    """
    daily = universe.filter(F.col(day).between(F.lit(start), F.lit(end))).groupBy(F.col(key), F.col(day).cast("date").alias("d")).agg(F.count("*").alias("n"))

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        name = pdf[key].iloc[0]
        days = dict(zip(pd.to_datetime(pdf["d"]).dt.date, pdf["n"], strict=True))
        sums = [0]
        for i in range((end - start).days + 1):
            sums.append(sums[-1] + int(days.get(start + timedelta(days=i), 0)))
        open_, out = [(start, end)], []
        while open_:
            a, b = open_.pop()
            n = sums[(b - start).days + 1] - sums[(a - start).days]
            if n <= most:
                out.append((name, a, b, n))
            elif a == b:
                raise SliceTooLarge(f"{name}: {n} rows on {a}, more than {most}")
            else:
                open_ += reversed(split(a, b))
        return pd.DataFrame(out, columns=[key, "slice_start", "slice_end", "planned_count"])

    kind = universe.schema[key].dataType.simpleString()
    return daily.groupBy(key).applyInPandas(plan, f"`{key}` {kind}, slice_start date, slice_end date, planned_count long")


def plan_slices_by_count(count: Callable[[date, date], int], start: date, end: date, most: int, known: int | None = None) -> list[tuple[date, date, int]]:
    """The same for a source that can only count: ``count(start, end)`` is asked once per interval."""
    n = count(start, end) if known is None else known
    if n <= most:
        return [(start, end, n)]
    if start == end:
        raise SliceTooLarge(f"{n} rows on {start}, more than {most}")
    return [s for a, b in split(start, end) for s in plan_slices_by_count(count, a, b, most)]


def plan_slices_by_level(windows: DataFrame, counts: Callable[[DataFrame], DataFrame], most: int, stuck: bool = True) -> DataFrame:
    """The same for many windows at once and a source that can only count: one question a level for all of them.

    ``windows`` has ``slice_start``, ``slice_end`` and other columns, which stay; ``counts`` gives a frame of windows back
    with ``records``, and may add columns. Windows with more than ``most`` records are replaced by their halves, level
    by level, until none is left: jobs grow with the depth, not with the number of windows. Columns are those
    of ``counts``, with ``planned_count`` in place of ``records``. Windows that ``counts`` gives no number (null) close
    as they are. A single day with too many raises ``SliceTooLarge``, or with ``stuck`` False closes with its number.
    """
    if most < 1:
        raise ValueError("the limit must be positive")
    columns, frontier, levels = windows.columns, windows, []
    while True:
        level = stored(counts(frontier), "frontier")
        large = level.filter(F.col("records") > most)
        days = large.filter("slice_start = slice_end").limit(5).collect()
        if days and stuck:
            raise SliceTooLarge("; ".join(f"{r['records']} rows on {r['slice_start']}, more than {most}" for r in days))
        large = large.filter("slice_start < slice_end")
        levels.append(level)
        if not large.limit(1).count():
            break
        middle = F.date_add("slice_start", F.floor(F.datediff("slice_end", "slice_start") / 2).cast("int"))
        halves = F.explode(F.array(F.struct(F.col("slice_start").alias("a"), middle.alias("z")), F.struct(F.date_add(middle, 1).alias("a"), F.col("slice_end").alias("z"))))
        frontier = large.withColumn("__half", halves).withColumns({"slice_start": F.col("__half.a"), "slice_end": F.col("__half.z")}).select(*columns)
    closed = reduce(DataFrame.unionByName, [level.filter(F.col("records").isNull() | (F.col("records") <= most) | F.col("slice_start").eqNullSafe(F.col("slice_end"))) for level in levels])
    plan = stored(closed.withColumnRenamed("records", "planned_count"), "plan")
    discard(*levels)
    return plan


def in_slices(df: DataFrame, day: str, key: str, slices: DataFrame) -> DataFrame:
    """Rows with the slice their day falls in (JOIN-08): days are enumerated, and the join is an equality."""
    days = slices.select(F.col(key), "slice_start", "slice_end", F.explode(F.sequence("slice_start", "slice_end")).alias("__day"))
    return df.withColumn("__day", F.col(day).cast("date")).join(days, [key, "__day"]).drop("__day")
