"""Statistics over calibration labels (STA-01..09)."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def confusion(df: DataFrame, by: Sequence[str], predicted: Column, actual: Column) -> DataFrame:
    """Counts of the four cells, per group."""
    p, a = F.coalesce(predicted, F.lit(False)), F.coalesce(actual, F.lit(False))
    return df.groupBy(*by).agg(F.count_if(p & a).alias("tp"), F.count_if(p & ~a).alias("fp"), F.count_if(~p & a).alias("fn"), F.count_if(~p & ~a).alias("tn"))


def ratio(a: Column, b: Column) -> Column:
    """a / b rounded to six digits; null if b is 0."""
    return F.round(F.try_divide(a.cast("double"), b.cast("double")), 6)


def recall_precision(cells: DataFrame) -> DataFrame:
    """Unweighted recall, precision, and count and rate of false negatives (STA-01, STA-05)."""
    t = cells.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn", "tn")])
    return t.select(ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"), ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), F.col("fn").alias("false_negatives"), ratio(F.col("fn"), F.col("fn") + F.col("tn")).alias("false_negative_rate"))


def weighted_recall(cells: DataFrame, sizes: DataFrame, stratum: str) -> DataFrame:
    """Recall in which each stratum weighs as in the population, N/n (STA-02); records without a stratum are one of their own."""
    known = sizes.select(F.col(stratum).alias("__stratum"), F.col("population_size").alias("big_n"))
    joined = cells.join(known, F.col(stratum).eqNullSafe(F.col("__stratum")))
    w = F.col("big_n").cast("double") / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    return joined.agg(F.round(F.try_divide(F.sum(w * F.col("tp")), F.sum(w * (F.col("tp") + F.col("fn")))), 6).alias("weighted_recall"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """Chance of k or more successes of n."""
    if p <= 0:
        return float(k <= 0)
    if p >= 1:
        return 1.0
    base = math.lgamma(n + 1)
    return math.fsum(math.exp(base - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(max(k, 0), n + 1))


def exact_interval(k: int, n: int, level: float = 0.95) -> tuple[float, float]:
    """Two-sided Clopper-Pearson interval, by bisection on the binomial tail."""
    if n == 0:
        return 0.0, 1.0
    alpha = (1 - level) / 2

    def solve(f) -> float:
        low, high = 0.0, 1.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if f(mid) else (low, mid)
        return (low + high) / 2

    lower = 0.0 if k == 0 else solve(lambda p: binomial_tail(k, n, p) < alpha)
    upper = 1.0 if k == n else solve(lambda p: 1 - binomial_tail(k + 1, n, p) > alpha)
    return lower, upper


def log_binomial_tail(k: Column, n: Column, p: Column) -> Column:
    """Logarithm of the chance of k or more successes of n (0 < k <= n, 0 < p < 1), as a column.

    The terms are gone through as logarithms, each from the one before, and summed with the largest taken out: nothing is lost to
    underflow, whichever side of the mean k is on.
    """
    one = F.lit(1.0)
    whole = F.aggregate(F.sequence(F.lit(1).cast("long"), k), F.lit(0.0), lambda a, j: a + F.log((n - k + j) / j))
    first = whole + k * F.log(p) + (n - k) * F.log1p(-p)
    odds = F.log(p) - F.log1p(-p)

    def step(s: Column, i: Column) -> Column:
        term = s["term"] + F.log((n - i + 1) / i) + odds
        top = F.greatest(s["top"], term)
        return F.struct(term.alias("term"), top.alias("top"), (s["sum"] * F.exp(s["top"] - top) + F.exp(term - top)).alias("sum"))

    rest = F.when(k < n, F.sequence(k + 1, n)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(rest, F.struct(first.alias("term"), first.alias("top"), one.alias("sum")), step, lambda s: s["top"] + F.log(s["sum"]))


def interval_columns(k: Column, n: Column, level: float = 0.95, rounds: int = 60) -> tuple[Column, Column]:
    """``exact_interval`` of longs as columns, by bisection on the binomial tail: no Python worker."""
    alpha = (1 - level) / 2

    def solve(at: Column, limit: float, below: bool) -> Column:
        def halve(s: Column, _: Column) -> Column:
            mid = (s["low"] + s["high"]) / 2
            tail = log_binomial_tail(at, n, mid)
            up = tail < math.log(limit) if below else tail < math.log1p(-limit)
            return F.struct(F.when(up, mid).otherwise(s["low"]).alias("low"), F.when(up, s["high"]).otherwise(mid).alias("high"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high")), halve, lambda s: (s["low"] + s["high"]) / 2)

    k, n = k.cast("long"), n.cast("long")
    return F.when(k == 0, 0.0).otherwise(solve(k, alpha, True)), F.when(k == n, 1.0).otherwise(solve(k + 1, alpha, False))


def stratum_recall(cells: DataFrame, stratum: str, least: int = 20) -> DataFrame:
    """Recall per stratum where there are ``least`` positives, else marked as underpowered, with an exact interval (STA-04)."""
    counted = cells.select(stratum, F.col("tp").cast("long").alias("tp"), (F.col("tp") + F.col("fn")).cast("long").alias("positives"))
    lower, upper = interval_columns(F.col("tp"), F.col("positives"))
    return counted.select(stratum, "positives", F.when(F.col("positives") >= least, ratio(F.col("tp"), F.col("positives"))).alias("recall"), (F.col("positives") < least).alias("underpowered"), F.round(lower, 6).alias("lower"), F.round(upper, 6).alias("upper"))


def bootstrap_recall(cells: DataFrame, sizes: DataFrame, stratum: str, replicates: int, seed: int) -> DataFrame:
    """Stratified bootstrap 95% interval of the weighted recall (STA-03).

    A stratum's draw depends on its four counts alone: a replicate is one multinomial per stratum,
    from a generator seeded by ``seed`` and its number, so that no partitioning changes it.
    """
    known = sizes.select(F.col(stratum).alias("__stratum"), "population_size")
    both = cells.join(known, F.col(stratum).eqNullSafe(F.col("__stratum"))).select(stratum, "population_size", "tp", "fp", "fn", "tn")
    rows = sorted((tuple(r) for r in both.collect()), key=lambda r: (r[0] is not None, r))
    spark = cells.sparkSession

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for rep in pdf["id"]:
                rng, top, bottom = np.random.default_rng([seed, int(rep)]), 0.0, 0.0
                for _, population, *c in rows:
                    n = sum(c)
                    if n:
                        tp, _, fn, _ = rng.multinomial(n, np.array(c) / n)
                        top, bottom = top + population / n * tp, bottom + population / n * (tp + fn)
                out.append(top / bottom if bottom else float("nan"))
            yield pd.DataFrame({"recall": out})

    reps = spark.range(replicates).mapInPandas(run, "recall double").filter("not isnan(recall)")
    return reps.agg(F.count("*").alias("replicates"), F.round(F.percentile("recall", F.lit(0.025)), 6).alias("lower"), F.round(F.percentile("recall", F.lit(0.975)), 6).alias("upper"))


def agreement(df: DataFrame, pairs: Sequence[tuple[str, str, str]], within: Sequence[tuple[str, str, str]] = ()) -> DataFrame:
    """Share of rows in which two raters agree exactly, or within one (STA-06, STA-08); nulls agree with nulls."""
    share = lambda c: F.round(F.avg(c.cast("double")), 6)
    exact = [share(F.col(a).eqNullSafe(F.col(b))).alias(name) for name, a, b in pairs]
    near = [share(F.coalesce(F.abs(F.col(a) - F.col(b)) <= 1, F.lit(False))).alias(name) for name, a, b in within]
    return df.agg(F.count("*").alias("n"), *exact, *near)


def adjudicated(reviews: DataFrame, item: str, reviewer: str, fields: Sequence[str]) -> DataFrame:
    """Final value of each field: that of the first two reviewers if they agree, else the third's (STA-08)."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(reviewer).alias("r"), *fields)))
    rows = reviews.groupBy(item).agg(listed.alias("x"))
    one, two, three = (F.get("x", F.lit(i)) for i in range(3))
    return rows.select(item, *[F.when(one[f].eqNullSafe(two[f]), one[f]).otherwise(three[f]).alias(f) for f in fields])


def gate(coverage: Column, recall: Column, worst_stratum: Column) -> Column:
    """Acceptance: everything covered, weighted recall of 0.95, each powered stratum's of 0.90 (STA-09)."""
    return (coverage >= 1) & (recall >= 0.95) & (F.coalesce(worst_stratum, F.lit(1.0)) >= 0.90)
