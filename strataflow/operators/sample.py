"""Deterministic samples by hash rank (TOP-01, TOP-02, WIN-03..05)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from strataflow.functions.scalars import hash_rank, share_of
from strataflow.operators.scratch import stored


class ShortStratum(ValueError):
    """A stratum has fewer members than its quota."""


def stratified_sample(df: DataFrame, key: str, stratum: str, quotas: dict[str, int], seed: str, check: bool = False) -> DataFrame:
    """The ``quotas[s]`` first members of each stratum in hash order, with the stratum's size.

    Columns: key, stratum, ``population_size``, ``hash_rank``, ``rank``. Sizes come from a partial
    aggregate, and only rows with hashes small enough for the quota are ranked, so that no stratum is gathered.
    """
    quota = F.create_map(*[F.lit(x) for k, v in quotas.items() for x in (k, v)])
    frame = df.select(key, F.col(stratum).alias("stratum")).filter(F.col("stratum").isin(*quotas)).withColumn("hash_rank", hash_rank(seed, F.col(key)))
    frame = stored(frame, "frame")  # what tells the strata may cost a scan of all texts
    sizes = frame.groupBy("stratum").agg(F.count("*").alias("population_size"))
    if check:
        have = {r["stratum"]: r["population_size"] for r in sizes.collect()}
        short = {s: have.get(s, 0) for s, k in quotas.items() if have.get(s, 0) < k}
        if short:
            raise ShortStratum(f"strata under their quotas: {short}")
    few = _beginnings(frame, sizes, quotas)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("stratum").orderBy("hash_rank", key))).filter(F.col("rank") <= max(quotas.values()))
    return ranked.filter(F.col("rank") <= quota[F.col("stratum")]).join(F.broadcast(sizes), "stratum").select(key, "stratum", "population_size", "hash_rank", F.col("rank").cast("long").alias("rank"))


def _beginnings(frame: DataFrame, sizes: DataFrame, quotas: dict[str, int]) -> DataFrame:
    """Rows of each stratum with the smallest hashes, as many as its quota at least: what meets in a stratum's task does not grow with it.

    Hashes spread evenly, so that a little over twice the quota's share of them is let pass. Strata for which that was too
    little, as when one key comes many times, have all their rows pass. The driver gets a row a stratum.
    """
    wanted = {r["stratum"]: (min(quotas[r["stratum"]], r["population_size"]), r["population_size"]) for r in sizes.collect()}
    top = {s: f"{min(16**12 - 1, int(16**12 * (2 * k + 40) / n)):012x}" for s, (k, n) in wanted.items() if n > 4 * k + 400}
    if not top:
        return frame
    limit = F.create_map(*[F.lit(x) for pair in top.items() for x in pair])[F.col("stratum")]
    passing = F.coalesce(F.col("hash_rank") < limit, F.lit(True))
    enough = {r["stratum"]: r["n"] for r in frame.filter(passing).groupBy("stratum").agg(F.count("*").alias("n")).collect()}
    short = [s for s in top if enough.get(s, 0) < wanted[s][0]]
    return frame.filter(passing | F.col("stratum").isin(short) if short else passing)


def _cut(frame: DataFrame, key: str, k: int, most: int) -> tuple | None:
    """The ``k``-th (hash_rank, key) of the table: counts of ever longer beginnings of the hash narrow it down until ``most`` rows are left."""
    begin = ""
    while True:
        part = frame.filter(F.col("hash_rank").startswith(begin)) if begin else frame
        if len(begin) >= 64 or part.count() <= most:
            return part.select("hash_rank", key).orderBy("hash_rank", key).collect()[k - 1]
        counts = sorted(part.groupBy(F.substring("hash_rank", 1, len(begin) + 3).alias("b")).count().collect())  # 4096 rows at most
        for row in counts:
            if k <= row["count"]:
                begin = row["b"]
                break
            k -= row["count"]


def fraction_sample(df: DataFrame, key: str, fraction: float, seed: str, most: int = 10_000) -> DataFrame:
    """The ``ceil(n * fraction)`` first rows in hash order; n is counted first.

    The last row that belongs to it is found by counts of beginnings of the hash, of which the driver gets
    4096 at a time, and in the end at most ``most`` rows; then the sample is a filter, however large it is.
    """
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be above 0 and at most 1")
    frame = stored(df.select(key).distinct().withColumn("hash_rank", hash_rank(seed, F.col(key))), "ranked")
    k = frame.agg(share_of(F.count("*"), fraction).cast("long").alias("k")).first()["k"]
    if not k:
        return frame.select(key, "hash_rank").limit(0)
    rank, last = _cut(frame, key, k, most)
    return frame.filter((F.col("hash_rank") < rank) | (F.col("hash_rank") == rank) & (F.col(key) <= F.lit(last))).select(key, "hash_rank")


def human_queue(decisions: DataFrame, key: str, decision: str, fraction: float, seed: str) -> DataFrame:
    """What people look at (STA-10): every latest YES and MAYBE, and a share of the NO by hash; ``key`` and ``reason``."""
    sure = decisions.filter(F.col(decision).isin("YES", "MAYBE")).select(key, F.col(decision).alias("reason"))
    chosen = fraction_sample(decisions.filter(F.col(decision) == "NO"), key, fraction, seed)
    return sure.union(chosen.select(key, F.lit("NO sample")))
