from datetime import date

import pytest
from pyspark.sql import functions as F

from strataflow.operators import batches, coverage, latest, sample, screen, slices, stats, upsert, validate

ROWS = "k string, v string, first string, n long"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_breaks_ties_and_filters_behind(spark):
    df = spark.createDataFrame([("a", 1, 1, "NO"), ("a", 1, 2, "YES"), ("b", 5, 1, "NO")], "k string, t long, id long, v string")
    top = latest.latest_by(df, ["k"], [F.desc("t"), F.desc("id")])
    assert rows(top.select("k", "v")) == [("a", "YES"), ("b", "NO")] == rows(latest.latest_by_max(df, ["k"], ["t", "id"]).select("k", "v"))
    assert rows(top.filter("v = 'NO'").select("k")) == [("b",)]
    left = spark.createDataFrame([("a",), ("z",)], "k string")
    assert rows(latest.with_latest(left, df, ["k"], [F.desc("t"), F.desc("id")], {"v": "none"})) == [("a", "YES"), ("z", "none")]


@pytest.mark.parametrize("parts", [1, 7])
def test_upsert_overwrites_nulls_keeps_first_and_is_idempotent(spark, parts):
    target = spark.createDataFrame([("a", "old", "r1", 1), ("b", "b", "r1", 1)], ROWS)
    source = spark.createDataFrame([("a", "x", "r2", 2), ("a", None, "r2", 3), ("c", "c", "r2", 1)], ROWS).repartition(parts)
    once = upsert.upsert(target, source, ["k"], [F.desc("n")], keep=["first"])
    assert rows(once.select("k", F.coalesce("v", F.lit("NULL")), "first")) == [("a", "NULL", "r1"), ("b", "b", "r1"), ("c", "c", "r2")]
    assert rows(upsert.upsert(once, source, ["k"], [F.desc("n")], keep=["first"]).select("k", "first", "n")) == rows(once.select("k", "first", "n"))


def test_insert_ignore_append_orphans_migrate(spark):
    target = spark.createDataFrame([("a", "1", "r", 1)], ROWS)
    source = spark.createDataFrame([("a", "2", "r", 2), ("b", "9", "r", 9), ("b", "1", "r", 1)], ROWS)
    assert rows(upsert.insert_ignore(target, source, ["k"], [F.asc("n")]).select("k", "v")) == [("a", "1"), ("b", "1")]
    assert upsert.inserted(target, source, ["k"], [F.asc("n")]).count() == 1
    with pytest.raises(upsert.DuplicateKey):
        upsert.append(target, source, ["k"])
    assert rows(upsert.orphans(source, target, ["k"]).select("k").distinct()) == [("b",)]
    moved = upsert.migrate(target, {"k": "string", "n": "int", "wrapper_version": "string"})
    assert moved.dtypes[2] == ("wrapper_version", "string") and rows(moved.select("k", "n")) == [("a", 1)]


def test_state_log(spark):
    log = spark.createDataFrame([("j", "pending", 1), ("j", "running", 2), ("j", "failed", 3), ("j", "running", 4), ("j", "complete", 5)], "k string, status string, t long")
    assert rows(upsert.state_of(log, ["k"], ["t"])) == [("j", "complete", 2, 5)]


def test_screening_flags_and_never_drops(spark):
    ddl = "pmid string, title string, abstract string, mesh_terms array<string>, article_types array<string>"
    df = spark.createDataFrame(
        [("1", "Pan-cancer single-cell atlas", "Transcriptomic profiling of tumor ecosystems", ["Neoplasms"], ["Journal Article"]), ("2", "A biological study", "No keywords here", [], ["Journal Article"]), ("3", "Cancer genomics", "A review of tumor single-cell studies", [], ["Review"]), ("4", None, None, None, None)], ddl
    )
    got = screen.screen(df, screen.RulePack("v1"), "2026-01-01T00:00:00Z")
    assert rows(got.select("pmid", "candidate_priority", "obvious_non_original_type")) == [("1", True, False), ("2", False, False), ("3", False, True), ("4", False, False)]
    assert rows(screen.screen_summary(got)) == [(4, 1, 1, 3)]
    types = spark.createDataFrame([(["Systematic Review"],), (["Journal Article"],), ([],), (["Randomized Controlled Trial"],)], "t array<string>")
    assert [r[0] for r in types.select(screen.stratum(F.lit(False), F.col("t"))).collect()] == ["obvious_non_original", "non_priority_original_or_unclear", "non_priority_original_or_unclear", None]


@pytest.mark.parametrize("parts", [1, 5])
def test_samples_are_the_same_however_dealt(spark, parts):
    df = spark.range(650).select(F.col("id").cast("string").alias("pmid"), F.when(F.col("id") < 310, "candidate_priority").when(F.col("id") < 510, "non_priority_original_or_unclear").otherwise("obvious_non_original").alias("s")).repartition(parts)
    quotas = {"candidate_priority": 300, "non_priority_original_or_unclear": 200, "obvious_non_original": 100}
    got = sample.stratified_sample(df, "pmid", "s", quotas, "seed", check=True)
    assert rows(got.groupBy("stratum", "population_size").count()) == [("candidate_priority", 310, 300), ("non_priority_original_or_unclear", 200, 200), ("obvious_non_original", 140, 100)]
    import hashlib

    want = sorted((hashlib.sha256(f"seed:{i}".encode()).hexdigest(), str(i)) for i in range(510, 650))[:100]
    assert rows(got.filter("stratum = 'obvious_non_original'").select("hash_rank", "pmid")) == want
    with pytest.raises(sample.ShortStratum):
        sample.stratified_sample(df, "pmid", "s", quotas | {"obvious_non_original": 141}, "seed", check=True)
    assert sample.fraction_sample(df.limit(21), "pmid", 0.10, "s").count() == 3
    with pytest.raises(ValueError):
        sample.fraction_sample(df, "pmid", 0.0, "s")


def test_slices(spark):
    start, end = date(2023, 1, 1), date(2026, 9, 2)
    asked = []

    def count(a, z):
        asked.append((a, z))
        return 15000 if (z - a).days > 700 else 7500

    plan = slices.plan_slices_by_count(count, start, end, 9999)
    assert len(plan) == 2 and plan[0][0] == start and plan[1][1] == end and (plan[1][0] - plan[0][1]).days == 1 and len(asked) == 3
    with pytest.raises(slices.SliceTooLarge):
        slices.plan_slices_by_count(lambda a, z: 5, start, start, 4)
    days = [("x", date(2020, 1, d % 28 + 1)) for d in range(100)]
    df = spark.createDataFrame(days, "k string, d date")
    got = slices.plan_slices(df, "k", "d", date(2020, 1, 1), date(2020, 1, 31), 20)
    counted = slices.plan_slices_by_count(lambda a, z: sum(a <= d <= z for _, d in days), date(2020, 1, 1), date(2020, 1, 31), 20)
    assert rows(got) == sorted(("x", *s) for s in counted)
    assert slices.in_slices(df, "d", "k", got).count() == 100


def test_coverage_is_a_distinct_union(spark):
    s = spark.createDataFrame([("r1", "complete"), ("r2", "complete"), ("r3", "failed")], "enumeration_run_id string, status string")
    m = spark.createDataFrame([("r1", "1"), ("r1", "2"), ("r2", "2"), ("r2", "3"), ("r3", "9")], "run_id string, pmid string")
    assert coverage.union_count(s, m).first()[0] == 3
    e = spark.createDataFrame([("a", 3), ("b", 0)], "k string, expected_count long")
    o = spark.createDataFrame([("a", 3), ("c", 1)], "k string, observed_count long")
    assert rows(coverage.reconcile(e, o, ["k"])) == [("a", 3, 3, "match"), ("b", 0, 0, "match"), ("c", 0, 1, "discrepancy")]
    empty = spark.createDataFrame([], "scope string, status string")
    assert rows(coverage.check_counts(empty, "annual")) == [(0, 0)] and rows(coverage.status_counts(empty, ("x", "y"))) == [(0, 0)]


def test_batches_and_sequences(spark):
    df = spark.range(600).select(F.format_string("%08d", "id").alias("pmid"), F.lit("s").alias("stratum"))
    assigned = batches.assign_batches(df, ["stratum", "pmid"], 20)
    made = batches.batch_manifests(assigned, "c", "v1")
    assert made.count() == 30 and made.select("batch_id").distinct().count() == 30 and made.filter("record_count = 20").count() == 30
    log = spark.createDataFrame([("a", 1, "failed"), ("a", 2, "valid"), ("b", 1, "valid"), ("b", 2, "failed"), ("c", 1, "failed"), ("c", 3, "valid")], "b string, n int, status string")
    assert rows(batches.sequence_check(log, ["b"], "n", F.col("status") == "valid")) == [("a", 2, True, True), ("b", 2, True, False), ("c", 2, False, True)]
    assert rows(batches.retry_metrics(log.filter("b <> 'c'"), "b", "n", F.col("status") == "valid")) == [(2, 4, 0.5, 1.0, 1.0)]
    assert rows(batches.sample_shape(df.limit(3), {"s": 3})) == [] and rows(batches.sample_shape(df.limit(3), {"s": 4, "t": 1})) == [("s", 4, 3), ("t", 1, 0)]
    expected = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "ordinal int, pmid string")
    lines = spark.createDataFrame([(1, "a"), (2, "a"), (4, "d")], "ordinal int, pmid string")
    assert rows(batches_errors(lines, expected)) == [(1, "duplicate id"), (2, "duplicate id"), (3, "missing line"), (4, "extra line")]


def batches_errors(lines, expected):
    return validate.positional_check(lines, expected).select("ordinal", "error")


GOOD = ("1", "cancer", "review", "other", ["scRNA"], 2, "none", "minor", "YES", 0.5, "why", "m", "v1", "2026-09-01T00:00:00Z")


def test_record_rules(spark):
    from strataflow.schemas import SEMANTIC

    ddl = SEMANTIC + ", model string, prompt_version string, screened_at string"
    names = [f.split(" ")[0] for f in ddl.split(", ")]
    bad = {"relevance": "PROBABLY", "data_modalities": ["scRNA", "scRNA"], "computational_centrality": 4, "confidence": 2.0, "model": " ", "pmid": "12a", "screened_at": "2026"}
    data = [GOOD] + [tuple(bad[k] if k == n else v for n, v in zip(names, GOOD, strict=True)) for k in bad]
    got = [r["first_error"] for r in validate.validate_records(spark.createDataFrame(data, ddl)).collect()]
    assert got[0] is None and all(got[1:]) and got[1] == "Invalid relevance" and got[6] == "pmid must contain only digits"


def test_sets_and_constraints(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "x int"), spark.createDataFrame([(2,), (1,), (1,)], "x int")
    assert validate.same_set(a, b) and not validate.same_set(a, b.filter("x = 1")) and not validate.disjoint(a, b)
    assert rows(validate.broken_constraints(b, {"small": F.col("x") < 2}, ["x"])) == [(2, ["small"])]


def test_interval_columns_equal_the_interval(spark):
    cases = [(0, 0), (0, 1), (1, 1), (0, 10), (3, 10), (10, 10), (1, 1000), (700, 1000), (999, 1000), (2500, 5000)]
    lower, upper = stats.interval_columns(F.col("k"), F.col("n"))
    got = spark.createDataFrame(cases, "k long, n long").select("k", "n", lower.alias("lower"), upper.alias("upper")).collect()
    for r in got:
        assert (r["lower"], r["upper"]) == pytest.approx(stats.exact_interval(r["k"], r["n"]), abs=1e-9), (r["k"], r["n"])


def test_statistics(spark):
    lower, upper = stats.exact_interval(0, 10)
    assert lower == 0 and abs(upper - (1 - 0.025 ** (1 / 10))) < 1e-9
    lower, upper = stats.exact_interval(10, 10)
    assert upper == 1 and abs(lower - 0.025 ** (1 / 10)) < 1e-9
    df = spark.createDataFrame([("a", True, True), ("a", False, True), ("b", True, True), ("b", True, False)], "s string, p boolean, t boolean")
    cells = stats.confusion(df, ["s"], F.col("p"), F.col("t"))
    sizes = spark.createDataFrame([("a", 20), ("b", 2)], "s string, population_size long")
    assert rows(stats.weighted_recall(cells, sizes, "s")) == [(round(11 / 21, 6),)]
    assert rows(stats.recall_precision(cells)) == [(0.666667, 0.666667, 1, 1.0)]
    one, two = (stats.bootstrap_recall(cells.repartition(n), sizes, "s", 200, 3).first() for n in (1, 3))
    assert one == two and 0 <= one["lower"] <= one["upper"] <= 1
    reviews = spark.createDataFrame([("i", "r1", "Y"), ("i", "r2", "N"), ("i", "r3", "N"), ("j", "r1", "Y"), ("j", "r2", "Y")], "item string, reviewer string, v string")
    assert rows(stats.adjudicated(reviews, "item", "reviewer", ["v"])) == [("i", "N"), ("j", "Y")]
