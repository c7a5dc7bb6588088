"""Ordered samples cut into batches, and attempts on them (WIN-04, WIN-06..08, FN-09, AGG-08, AGG-09, VAL-06..08)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from strataflow.functions.scalars import batch_id
from strataflow.operators.scratch import stored


def assign_batches(sample: DataFrame, order: Sequence[str], size: int, key: str = "pmid") -> DataFrame:
    """Key, ``batch_no`` (from 0) and ``ordinal`` (from 1) of each row of a sample in a global order.

    For samples, whose size their quotas bound: the order takes one task.
    """
    n = F.row_number().over(Window.orderBy(*order)).cast("long")
    return sample.select(key, n.alias("n")).select(key, F.floor((F.col("n") - 1) / size).alias("batch_no"), ((F.col("n") - 1) % size + 1).alias("ordinal"))


def global_position(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """All rows with their ``position`` (from 1) in ``order``, which has to name a total order.

    Rows are dealt by ranges of the order and numbered in them; a range's offset is the number of rows
    in the ranges before it. No task holds more than a range, and the driver gets a row a range.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    table = stored(ranged, "positions").withColumn("__range", F.shiftright("__at", 33))
    offsets, total = [], 0
    for r in sorted(table.groupBy("__range").count().collect()):
        offsets.append((r["__range"], total))
        total += r["count"]
    known = df.sparkSession.createDataFrame(offsets, "__range long, __offset long")
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("__offset") + 1
    return table.join(F.broadcast(known), "__range").select(*df.columns, place.alias("position"))


def corpus_batches(df: DataFrame, order: Sequence[Column], size: int, key: str = "pmid") -> DataFrame:
    """The same for a whole corpus (STA-11): its order is dealt by ranges, so that no task holds it."""
    n = F.col("position") - 1
    return global_position(df, order).select(key, F.floor(n / size).alias("batch_no"), (n % size + 1).alias("ordinal"))


def batch_manifests(assigned: DataFrame, sample_id: str, prompt_version: str, key: str = "pmid") -> DataFrame:
    """A row per batch: id, ordered keys, number of records."""
    listed = assigned.groupBy("batch_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", F.col(key).cast("string").alias("k")))), lambda x: x["k"]).alias("ordered_keys"))
    return listed.select(batch_id(F.lit(sample_id), F.lit(prompt_version), F.col("ordered_keys")).alias("batch_id"), "batch_no", "ordered_keys", F.size("ordered_keys").cast("long").alias("record_count"))


def sample_shape(sample: DataFrame, quotas: dict[str, int]) -> DataFrame:
    """Strata whose number of rows is not the expected one: must be empty (AGG-08)."""
    spark = sample.sparkSession
    want = spark.createDataFrame(sorted(quotas.items()), "stratum string, expected_count long")
    have = sample.groupBy("stratum").agg(F.count("*").alias("observed_count"))
    return want.join(have, "stratum", "full").na.fill(0, ["expected_count", "observed_count"]).filter("expected_count <> observed_count")


def contiguous(df: DataFrame, group: Sequence[str], place: str) -> DataFrame:
    """Per group: first and last place, number of rows, and whether they fill a gapless range (WIN-07)."""
    agg = df.groupBy(*group).agg(F.min(place).cast("long").alias("first_place"), F.max(place).cast("long").alias("last_place"), F.count("*").alias("n"), F.countDistinct(place).alias("d"))
    return agg.select(*group, "first_place", "last_place", "n", ((F.col("last_place") - F.col("first_place") + 1 == F.col("n")) & (F.col("n") == F.col("d"))).alias("contiguous"))


def sequence_check(df: DataFrame, group: Sequence[str], number: str, final: Column | None = None) -> DataFrame:
    """Per group: are numbers consecutive from ``1``, and is there at most one final row, in last place (WIN-06, VAL-07).

    Aggregates say so without a window: n distinct numbers with least 1 and greatest n.
    """
    final = F.lit(False) if final is None else final
    agg = df.groupBy(*group).agg(F.count("*").alias("attempts"), F.min(number).alias("lo"), F.max(number).alias("hi"), F.countDistinct(number).alias("d"), F.count_if(final).alias("finals"), F.max(F.when(final, F.col(number))).alias("final_at"))
    consecutive = (F.col("lo") == 1) & (F.col("hi") == F.col("attempts")) & (F.col("d") == F.col("attempts"))
    last = (F.col("finals") == 0) | ((F.col("finals") == 1) & (F.col("final_at") == F.col("hi")))
    return agg.select(*group, "attempts", consecutive.alias("consecutive"), last.alias("final_is_last"))


def repeats(df: DataFrame, key: str, order: str) -> DataFrame:
    """Rows behind the first of their key (WIN-08): a minimum and a join, so that a hot key does not fill one task."""
    first = df.groupBy(key).agg(F.min(order).alias("first_row"))
    return df.join(first, key).filter(F.col(order) > F.col("first_row"))


def retry_metrics(attempts: DataFrame, batch: str, number: str, valid: Column) -> DataFrame:
    """First-attempt validity, completion and retry rate over batches (STA-07)."""
    per = attempts.groupBy(batch).agg(F.min_by(valid, F.col(number)).alias("first_valid"), F.max(valid).alias("done"), F.count("*").alias("n"))
    share = lambda c: F.round(F.avg(c.cast("double")), 6)
    return per.agg(F.count("*").alias("batches"), F.sum("n").alias("attempts"), share(F.col("first_valid")).alias("first_attempt_validity"), share(F.col("done")).alias("completion"), share(F.col("n") > 1).alias("retry_rate"))
