"""The operators applied to the driver's tables, and the SQL that says the same.

documents carry articles (lang as article type), labels decisions (quality 0/1 as NO/YES, toxic as
a second rater), orders and lineitem a dated universe and overlapping slices, events a versioned
log, conversations batches and attempts, pages marked-up sources, nation and customer a registry
and its hits.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.functions.scalars import batch_id, collapse_space, coverage_status, hash_rank, midpoint, normalize_doi, ordered_distinct, partial_date, year_bounds, years_between
from strataflow.functions.vocabularies import FULL_TEXT_STATUSES, MODALITIES, RECORD_ENUMS
from strataflow.operators import batches, coverage, latest, sample, screen, slices, stats, transitions, upsert, validate
from strataflow.operators.scratch import shared_dir, stored
from strataflow.operators.screen import RulePack
from strataflow.plans.packets import import_file
from strataflow.plans.store import Store
from strataflow.schemas import checks
from strataflow.sinks.files import file_digests, write_pages
from strataflow.sources.config import Journal, Registry, journal_actions
from strataflow.sources.introspect import table_info as info_of
from strataflow.sources.jsonl import read_records
from strataflow.sources.paged import Snapshot
from strataflow.sources.xml_records import parse_records

GUARD, TAIL = r"(^|[^\p{L}\p{N}_])", r"([^\p{L}\p{N}_]|$)"
GROUP_A = tuple(f"{GUARD}{w}{TAIL}" for w in ("the", "of"))
GROUP_B = tuple(f"{GUARD}{w}{TAIL}" for w in ("and", "que"))
QUOTAS = {"candidate_priority": 20, "non_priority_original_or_unclear": 20, "obvious_non_original": 20}
SEED = "seed"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def put(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RULES = RulePack("v1", GROUP_A, GROUP_B)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as articles: the text is the abstract, the language stands for the article type (none for null)."""
    kind = F.when(F.col("lang") == "de", F.array(F.lit("Review"))).when(F.col("lang") == "es", F.array(F.lit("Unlisted"))).when(F.col("lang").isNull(), F.array().cast("array<string>")).otherwise(F.array(F.lit("Journal Article")))
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", F.lit(None).cast("string").alias("title"), F.col("text").alias("abstract"), F.array().cast("array<string>").alias("mesh_terms"), kind.alias("article_types"))


def screened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with hits of both groups, flags and stratum, in one scan."""
    made = screen.screen(articles(spark, sf_dir), RULES, "2026-01-01T00:00:00Z", "doc_id", carry=("lang", "article_types"))
    return made.withColumn("stratum", screen.stratum(F.col("candidate_priority"), F.col("article_types")))


def _hit(patterns: tuple[str, ...]) -> str:
    return "[x for x in [" + ", ".join(f"CASE WHEN regexp_matches(coalesce(text, ''), '(?i){p}') THEN '{p}' END" for p in patterns) + "] if x IS NOT NULL]"


SCREENED = f"""h AS (SELECT doc_id, lang, source, {_hit(GROUP_A)} AS a, {_hit(GROUP_B)} AS b FROM documents),
g AS (SELECT *, len(a) > 0 AS a_hit, len(b) > 0 AS b_hit, coalesce(lang = 'de', false) AS non_original FROM h),
s AS (SELECT *, a_hit AND b_hit AND NOT non_original AS candidate_priority, CASE WHEN a_hit AND b_hit AND NOT non_original THEN 'candidate_priority' WHEN non_original THEN 'obvious_non_original' WHEN coalesce(lang, '') <> 'es' THEN 'non_priority_original_or_unclear' END AS stratum FROM g)"""


@query(f"""WITH {SCREENED}, r AS (SELECT doc_id, stratum, sha256('{SEED}:' || doc_id) AS hash_rank, count(*) OVER (PARTITION BY stratum) AS population_size FROM s WHERE stratum IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY hash_rank, doc_id) AS rank FROM r) SELECT doc_id, stratum, population_size, hash_rank, rank FROM k WHERE rank <= 20""")
def stratified_hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TOP-01, WIN-03, WIN-05, FN-07, FN-08."""
    return sample.stratified_sample(screened(spark, sf_dir), "doc_id", "stratum", QUOTAS, SEED)


@query(f"WITH {SCREENED} SELECT doc_id, a_hit, b_hit, non_original, candidate_priority, array_to_string(a, ';') AS a_terms, array_to_string(b, ';') AS b_terms FROM s")
def screen_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-05, FN-06, PRJ-06, SRC-12."""
    flags = {"cancer_hit": "a_hit", "omics_hit": "b_hit", "obvious_non_original_type": "non_original", "candidate_priority": "candidate_priority"}
    return screened(spark, sf_dir).select("doc_id", *[F.col(k).alias(v) for k, v in flags.items()], F.array_join("cancer_terms", ";").alias("a_terms"), F.array_join("omics_terms", ";").alias("b_terms"))


@query(f"WITH {SCREENED} SELECT count(*) AS screened, count(*) FILTER (candidate_priority) AS candidate_priority, count(*) FILTER (non_original) AS obvious_non_original_type, count(*) - count(*) FILTER (candidate_priority) AS unmatched_not_excluded FROM s")
def screen_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-05."""
    return screen.screen_summary(screened(spark, sf_dir))


@query(f"WITH {SCREENED} SELECT coalesce(stratum, 'outside') AS stratum, count(*) AS population FROM s GROUP BY 1")
def strata_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-07, AGG-07: records outside the frame are counted too."""
    return screened(spark, sf_dir).groupBy(F.coalesce("stratum", F.lit("outside")).alias("stratum")).agg(F.count("*").alias("population"))


LATEST = "l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)"


def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest.latest_by(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])


@query(f"WITH {LATEST} SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type FROM l WHERE rn = 1")
def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-01, WIN-02."""
    return latest_events(spark, sf_dir).select("user_id", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "event_type")


@query(f"WITH {LATEST} SELECT user_id, event_id FROM l WHERE rn = 1 AND event_type = 'error'")
def latest_then_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-06: an older error that a newer event supersedes is out."""
    return latest_events(spark, sf_dir).filter("event_type = 'error'").select("user_id", "event_id")


NO_SAMPLE = "n AS (SELECT DISTINCT doc_id, sha256('audit:' || doc_id) AS hash_rank FROM labels WHERE quality = 0), c AS (SELECT *, row_number() OVER (ORDER BY hash_rank, doc_id) AS rn, count(*) OVER () AS t FROM n), a AS (SELECT doc_id, hash_rank FROM c WHERE rn <= ceil(t * CAST(0.1 AS DOUBLE)))"


@query(f"WITH {NO_SAMPLE} SELECT doc_id, hash_rank, 'NO' AS source_relevance FROM a")
def audit_no_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TOP-02, FN-21, PRJ-04."""
    no = table(spark, sf_dir, "labels").filter("quality = 0")
    return sample.fraction_sample(no, "doc_id", 0.1, "audit").withColumn("source_relevance", F.lit("NO"))


@query("SELECT d.doc_id, lang, coalesce(quality, 0) = 1 AS candidate_priority, row_number() OVER (ORDER BY coalesce(quality, 0) DESC, n_chars DESC, d.doc_id DESC) AS position FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-03, PRJ-01..03, SRT-01: every record with its place in the review queue."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), table(spark, sf_dir, "labels")
    queue = latest.with_latest(docs, labels, ["doc_id"], [F.desc("quality")], {"quality": 0})
    placed = batches.global_position(queue, [F.desc("quality"), F.desc("n_chars"), F.desc("doc_id")])
    return placed.select("doc_id", "lang", (F.col("quality") == 1).alias("candidate_priority"), "position")


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-06, FLT-07, FLT-08."""
    return upsert.orphans(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), ["doc_id"])


MEMBERS = "m AS (SELECT DISTINCT year(l_shipdate) AS y, l_orderkey FROM lineitem)"


def year_slices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Order lines as the members of a slice a ship year, all of them complete: slices and membership."""
    members = table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").cast("string").alias("run_id"), F.col("l_orderkey").cast("string").alias("pmid")).distinct()
    return members.select(F.col("run_id").alias("enumeration_run_id"), F.lit("complete").alias("status")).distinct(), members


@query(f"WITH {MEMBERS} SELECT count(*) AS slice_members, count(DISTINCT l_orderkey) AS distinct_members FROM m")
def slice_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-01, AGG-11, SET-01, JOIN-01, REC-01: members added over slices against their distinct union."""
    made, members = year_slices(spark, sf_dir)
    added = members.agg(F.count("*").alias("slice_members"))
    return added.crossJoin(F.broadcast(coverage.union_count(made, members).withColumnRenamed("observed_count", "distinct_members")))


COVERAGE = """y AS (SELECT CAST(unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1)) AS INT) AS y FROM orders), p AS (SELECT DISTINCT o_orderpriority AS p FROM orders),
e AS (SELECT o_orderpriority AS p, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY ALL),
o AS (SELECT o_orderpriority AS p, year(l_shipdate) AS y, count(DISTINCT o_orderkey) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
c AS (SELECT p.p AS priority, y.y::INT AS year, coalesce(e.n, 0) AS expected_count, coalesce(o.n, 0) AS observed_count FROM p CROSS JOIN y LEFT JOIN e ON e.p = p.p AND e.y = y.y LEFT JOIN o ON o.p = p.p AND o.y = y.y),
k AS (SELECT *, CASE WHEN expected_count = observed_count THEN 'match' ELSE 'discrepancy' END AS status FROM c)"""


def coverage_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    span = orders.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("z")).select(F.explode(years_between(F.col("a"), F.col("z"))).alias("year"))
    grid = orders.select(F.col("o_orderpriority").alias("priority")).distinct().crossJoin(F.broadcast(span))  # JOIN-09: keys x years
    want = orders.groupBy(F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("expected_count"))
    seen = lines.select("l_orderkey", F.year("l_shipdate").alias("year")).distinct().join(orders.select("o_orderkey", F.col("o_orderpriority").alias("priority")), F.col("l_orderkey") == F.col("o_orderkey")).groupBy("priority", "year").agg(F.countDistinct("o_orderkey").alias("observed_count"))
    keys = ["priority", "year"]
    return grid.join(coverage.reconcile(want, seen, keys), keys, "left").select(*keys, F.coalesce("expected_count", F.lit(0)).alias("expected_count"), F.coalesce("observed_count", F.lit(0)).alias("observed_count"), F.coalesce("status", F.lit("match")).alias("status"))


@query(f"WITH {COVERAGE} SELECT * FROM k")
def coverage_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-01, REC-02, JOIN-02, JOIN-09, FN-19, FN-22."""
    return coverage_checks(spark, sf_dir)


@query(f"WITH {COVERAGE} SELECT count(*) FILTER (status = 'match') AS \"match\", count(*) FILTER (status = 'discrepancy') AS discrepancy, count(*) FILTER (status = 'pending') AS pending, count(*) AS checks, coalesce(sum(expected_count), 0)::BIGINT AS expected_total FROM k")
def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-02, AGG-03, REC-03."""
    checks = coverage_checks(spark, sf_dir)
    totals = checks.agg(F.count("*").alias("checks"), F.coalesce(F.sum("expected_count"), F.lit(0)).alias("expected_total"))
    return coverage.status_counts(checks, ("match", "discrepancy", "pending")).crossJoin(F.broadcast(totals))


@query(f"""WITH {COVERAGE}, {MEMBERS}, f AS (SELECT priority, sum(expected_count) AS e, sum(observed_count) AS o FROM k GROUP BY priority),
j AS (SELECT priority, bool_and(status = 'match') AS good FROM k GROUP BY priority)
SELECT 'b1' AS backfill_id, count(*) FILTER (good) AS completed_journals, count(*) FILTER (NOT good) AS failed_journals, 0::BIGINT AS pending_journals, (SELECT count(DISTINCT l_orderkey) FROM m) AS unique_articles,
(SELECT count(*) FROM k) AS annual_checks, (SELECT count(*) FROM k WHERE status = 'discrepancy') AS annual_discrepancies, (SELECT count(*) FROM f) AS full_window_checks, (SELECT count(*) FROM f WHERE e <> o) AS full_window_discrepancies FROM j""")
def backfill_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-03, REC-03, AGG-02: order priorities as journals, their years as annual checks."""
    annual = stored(coverage_checks(spark, sf_dir), "checks")
    journals = annual.groupBy("priority").agg(F.when(F.count_if(F.col("status") == "discrepancy") == 0, "complete").otherwise("failed").alias("status"))
    full = annual.groupBy("priority").agg(F.sum("expected_count").alias("e"), F.sum("observed_count").alias("o")).select(F.lit("full_window").alias("scope"), F.when(F.col("e") == F.col("o"), "match").otherwise("discrepancy").alias("status"))
    run = spark.createDataFrame([("b1",)], "backfill_id string")
    return coverage.backfill_summary(run, journals, *year_slices(spark, sf_dir), annual.select(F.lit("annual").alias("scope"), "status").union(full))


@query(f"""WITH {COVERAGE}, {MEMBERS}, a AS (SELECT priority, string_agg(concat_ws('/', year, expected_count, observed_count, status), ';' ORDER BY year) AS annual, CASE WHEN bool_and(status = 'match') THEN 'complete' ELSE 'failed' END AS state FROM k GROUP BY priority),
f AS (SELECT priority, concat_ws('/', sum(expected_count), sum(observed_count), CASE WHEN sum(expected_count) = sum(observed_count) THEN 'match' ELSE 'discrepancy' END) AS full_window FROM k GROUP BY priority),
yearly AS (SELECT o_orderpriority AS priority, year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY ALL), sl AS (SELECT priority, string_agg(year || ':' || n, ';' ORDER BY year) AS slices FROM yearly GROUP BY priority)
SELECT a.priority, a.state, a.annual, f.full_window, sl.slices FROM a JOIN f USING (priority) JOIN sl USING (priority)""")
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-10, SNK-04: a row per priority with its state and its years, full window and slices as ordered lists, here written as text."""
    annual = stored(coverage_checks(spark, sf_dir), "checks")
    journals = annual.groupBy(F.col("priority").alias("journal_key")).agg(F.when(F.count_if(F.col("status") == "discrepancy") == 0, "complete").otherwise("failed").alias("status"))
    yearly = annual.select(F.col("priority").alias("journal_key"), F.lit("annual").alias("scope"), F.col("year").alias("period_start"), "expected_count", "observed_count", "status")
    whole = annual.groupBy(F.col("priority").alias("journal_key")).agg(F.sum("expected_count").alias("expected_count"), F.sum("observed_count").alias("observed_count"))
    whole = whole.select("journal_key", F.lit("full_window").alias("scope"), F.lit(0).alias("period_start"), "expected_count", "observed_count", coverage_status(F.col("expected_count"), F.col("observed_count")).alias("status"))
    parts = universe(spark, sf_dir).groupBy(F.col("priority").alias("journal_key"), F.year("day").alias("slice_start")).agg(F.count("*").alias("planned_count"))
    rows = coverage.report_rows(journals, yearly.unionByName(whole), parts)
    said = lambda c, *f: F.array_join(F.transform(c, lambda x: F.concat_ws("/", *[x[k].cast("string") for k in f])), ";")
    counts = ("expected_count", "observed_count", "status")
    listed = F.array_join(F.transform("slices", lambda x: F.concat_ws(":", x["slice_start"].cast("string"), x["planned_count"].cast("string"))), ";")
    return rows.select(F.col("journal_key").alias("priority"), F.col("journal.status").alias("state"), said("annual_coverage", "period_start", *counts).alias("annual"), said("full_window_coverage", *counts).alias("full_window"), listed.alias("slices"))


FIRST, LAST, MOST = date(1995, 1, 1), date(2001, 12, 31), 1000


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").cast("date").alias("day"))


def as_text(df: DataFrame) -> DataFrame:
    """Dates as ISO text, which both engines write alike."""
    return df.select(*[F.col(c).cast("string").alias(c) if t == "date" else c for c, t in df.dtypes])


DATE_SLICES = f"""WITH RECURSIVE u AS (SELECT o_orderpriority AS priority, CAST(o_orderdate AS DATE) AS day FROM orders),
t AS (SELECT p.priority, DATE '{FIRST}' AS a, DATE '{LAST}' AS z, (SELECT count(*) FROM u WHERE u.priority = p.priority AND day BETWEEN DATE '{FIRST}' AND DATE '{LAST}') AS n FROM (SELECT DISTINCT priority FROM u) p
UNION ALL SELECT h.priority, h.a, h.z, (SELECT count(*) FROM u WHERE u.priority = h.priority AND day BETWEEN h.a AND h.z) FROM (
  SELECT priority, CASE s WHEN 0 THEN a ELSE a + CAST((z - a) // 2 AS INT) + 1 END AS a, CASE s WHEN 0 THEN a + CAST((z - a) // 2 AS INT) ELSE z END AS z FROM t, (VALUES (0), (1)) v(s) WHERE n > {MOST}) h)
SELECT priority, CAST(a AS VARCHAR) AS slice_start, CAST(z AS VARCHAR) AS slice_end, n AS planned_count FROM t WHERE n <= {MOST}"""


@query(DATE_SLICES)
def date_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PLN-01, FN-20: at most ``MOST`` rows a slice; a day with more raises ``SliceTooLarge``, as no slice can hold it."""
    return as_text(slices.plan_slices(universe(spark, sf_dir), "priority", "day", FIRST, LAST, MOST))


@query(f"SELECT priority, slice_start, slice_end, planned_count, planned_count AS members FROM ({DATE_SLICES}) WHERE planned_count > 0")
def slice_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-08, FLT-04: rows joined to the slice that holds their day."""
    plan = slices.plan_slices(universe(spark, sf_dir), "priority", "day", FIRST, LAST, MOST)
    inside = slices.in_slices(universe(spark, sf_dir), "day", "priority", plan).groupBy("priority", "slice_start", "slice_end").agg(F.count("*").alias("members"))
    return as_text(plan.join(inside, ["priority", "slice_start", "slice_end"]))


@query(DATE_SLICES)
def level_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PLN-02: the same slices from a source that can only count, asked once a level for all priorities."""
    source = Snapshot(universe(spark, sf_dir), "priority", "day")
    windows = universe(spark, sf_dir).select(F.col("priority").alias("title")).distinct().select("title", F.lit(FIRST).alias("slice_start"), F.lit(LAST).alias("slice_end"))
    return as_text(slices.plan_slices_by_level(windows, source.counts, MOST).withColumnRenamed("title", "priority"))


@query("SELECT user_id, arg_min(event_id, (ts, event_id)) AS first_event, arg_max(event_id, (ts, event_id)) AS last_event, arg_max(event_type, (ts, event_id)) AS event_type, round(arg_max(coalesce(value, -1), (ts, event_id)), 6) AS value FROM events GROUP BY user_id")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPS-01, UPS-03, UPS-04: a log put over the first row of each key; first seen stays, all else is the last, nulls included."""
    log = table(spark, sf_dir, "events").select("user_id", "ts", F.col("event_id").alias("first_event"), F.col("event_id").alias("last_event"), "event_type", F.coalesce("value", F.lit(-1.0)).alias("value"))
    target = latest.latest_by(log, ["user_id"], [F.asc("ts"), F.asc("last_event")])
    return upsert.upsert(target, log, ["user_id"], [F.desc("ts"), F.desc("last_event")], keep=["first_event"]).select("user_id", "first_event", "last_event", "event_type", F.round("value", 6).alias("value"))


#: How a user's log may go on: what is signed up or in error begins anew, a purchase follows a click or another purchase.
STEPS = (
    (None, "signup"), (None, "view"), ("signup", "view"), ("signup", "click"), ("view", "view"), ("view", "click"), ("click", "view"), ("click", "click"),
    ("click", "purchase"), ("purchase", "purchase"), ("purchase", "view"), *((x, "error") for x in ("signup", "view", "click", "purchase")), ("error", "view"), ("error", "signup"),
)


@query(f"""WITH steps(a, b) AS (VALUES {', '.join("(" + ("NULL" if a is None else repr(a)) + f", {b!r})" for a, b in STEPS)}),
e AS (SELECT event_id, user_id, event_type, lag(event_type) OVER w AS previous, row_number() OVER w = 1 AS is_first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, event_type, previous FROM e WHERE NOT EXISTS (SELECT 1 FROM steps WHERE b = event_type AND CASE WHEN is_first THEN a IS NULL ELSE a = previous END)""")
def illegal_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPS-11: every event of a user that may not follow the one before it."""
    log = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return transitions.illegal_transitions(log, ["user_id"], ["ts", "event_id"], "event_type", STEPS).drop("ts")


@query("SELECT user_id, arg_min(event_id, (ts, event_id)) AS first_event, arg_max(event_id, (ts, event_id)) AS last_event FROM events GROUP BY user_id")
def log_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPS-10: the same end state from the log alone, by one aggregate."""
    log = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.col("event_id").alias("first_event"), F.col("event_id").alias("last_event"))
    return upsert.first_seen(log, ["user_id"], ["ts", "event_id"], ["first_event"]).select("user_id", "first_event", "last_event")


@query("""WITH t AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, min(event_id) AS first_id FROM events WHERE event_id % 2 = 0 GROUP BY user_id),
s AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, min(event_id) AS first_id FROM events WHERE event_id % 2 = 1 GROUP BY user_id)
SELECT coalesce(t.user_id, s.user_id) AS user_id, CASE WHEN s.user_id IS NOT NULL THEN s.event_type ELSE t.event_type END AS event_type, CASE WHEN t.user_id IS NOT NULL THEN t.first_id ELSE s.first_id END AS first_id FROM t FULL JOIN s ON t.user_id = s.user_id""")
def upsert_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPS-01, UPS-08: one snapshot put over another; the target's first id stays."""
    events = table(spark, sf_dir, "events")

    def half(odd: int) -> DataFrame:
        return events.filter(F.col("event_id") % 2 == odd).groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type"), F.min("event_id").alias("first_id"))

    return upsert.upsert(half(0), half(1), ["user_id"], [F.asc("first_id")], keep=["first_id"])


@query("""WITH d AS (SELECT sha256(text) AS digest, doc_id FROM documents), t AS (SELECT digest, min(doc_id) AS doc_id FROM d WHERE doc_id % 3 = 0 GROUP BY digest)
SELECT digest, doc_id, false AS inserted FROM t UNION ALL SELECT digest, min(doc_id) AS doc_id, true AS inserted FROM d WHERE doc_id % 3 <> 0 AND digest NOT IN (SELECT digest FROM t WHERE digest IS NOT NULL) GROUP BY digest""")
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPS-02, UPS-05..07: rows whose natural key the target lacks, the first of each; what is there stays."""
    rows = table(spark, sf_dir, "documents").select(F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "doc_id")
    target = rows.filter("doc_id % 3 = 0").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("inserted", F.lit(False))
    return upsert.insert_ignore(target, rows.filter("doc_id % 3 <> 0").withColumn("inserted", F.lit(True)), ["digest"], [F.asc("doc_id")])


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, count(*) FILTER (event_type = 'error') AS attempt_count, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS changed_at FROM events GROUP BY user_id")
def state_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPS-10, UPS-11."""
    return upsert.state_of(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "event_type", "error").withColumn("changed_at", F.date_format("changed_at", "yyyy-MM-dd HH:mm:ss"))


@query("SELECT n_nationkey AS key, n_name AS title, count(c_custkey) AS hit_count, count(c_custkey) > 0 AS valid FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def registry_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REC-04, PRJ-05, SRC-03: all customers of each nation, 0 where none; nations are a registry's entries, looked up by key."""
    rows = sorted(table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect())  # a registry is a file of a few entries
    whole = Registry("v1", "", tuple(Journal(str(k), name, name, "Gold", (), float(n)) for n, (k, name) in enumerate(rows)))
    registry = Registry("v1", "", tuple(whole.by_key(str(k)) for k, _ in rows)).frame(spark)
    hits = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("key"))
    kind = table(spark, sf_dir, "nation").schema["n_nationkey"].dataType
    return coverage.registry_check(registry.select("key", "title"), hits).withColumn("key", F.col("key").cast(kind))


@query("SELECT (SELECT count(*) FROM documents) AS articles, (SELECT count(DISTINCT doc_id) FROM labels) AS screened, (SELECT count(*) FROM labels WHERE quality = 1) AS yes, (SELECT count(*) FROM labels WHERE quality = 0) AS no, (SELECT count(DISTINCT user_id) FROM events) AS users, (SELECT count(*) FROM events WHERE event_type IN ('error', 'view')) AS attempts, (SELECT count(DISTINCT conv_id) FROM conversations) AS batches")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-04, FLT-01, FLT-03: one aggregate a table, one row each."""
    parts = [
        table(spark, sf_dir, "documents").agg(F.count("*").alias("articles")),
        table(spark, sf_dir, "labels").agg(F.countDistinct("doc_id").alias("screened"), F.count_if(F.col("quality") == 1).alias("yes"), F.count_if(F.col("quality") == 0).alias("no")),
        table(spark, sf_dir, "events").agg(F.countDistinct("user_id").alias("users"), F.count_if(F.col("event_type").isin("error", "view")).alias("attempts")),
        table(spark, sf_dir, "conversations").agg(F.countDistinct("conv_id").alias("batches")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(F.broadcast(p))
    return out


SAMPLE = f"""WITH {SCREENED}, r AS (SELECT doc_id, stratum, sha256('{SEED}:' || doc_id) AS hash_rank FROM s WHERE stratum IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY hash_rank, doc_id) AS rank FROM r), q AS (SELECT *, row_number() OVER (ORDER BY stratum, hash_rank) AS n FROM k WHERE rank <= 20),
b AS (SELECT doc_id, (n - 1) // 20 AS batch_no, (n - 1) % 20 + 1 AS ordinal FROM q)"""


@query(f"{SAMPLE} SELECT batch_no, count(*) AS record_count, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY ordinal) AS keys, substring(sha256('sample' || chr(10) || 'v1' || chr(10) || string_agg(CAST(doc_id AS VARCHAR), chr(10) ORDER BY ordinal)), 1, 24) AS batch_id FROM b GROUP BY batch_no")
def web_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-04, FN-09, AGG-09, SRT-02."""
    chosen = stratified_hash_sample(spark, sf_dir)
    made = batches.batch_manifests(batches.assign_batches(chosen, ["stratum", "hash_rank"], 20, "doc_id"), "sample", "v1", "doc_id")
    return made.select("batch_no", "record_count", F.array_join("ordered_keys", ",").alias("keys"), "batch_id")


@query("SELECT conv_id, count(*) AS attempts, min(turn + 1) = 1 AND max(turn + 1) = count(*) AND count(DISTINCT turn) = count(*) AS consecutive, count(*) FILTER (role = 'assistant') = 0 OR (count(*) FILTER (role = 'assistant') = 1 AND max(turn) FILTER (role = 'assistant') = max(turn)) AS final_is_last FROM conversations GROUP BY conv_id")
def attempt_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-06, VAL-07: turns as attempts, numbered from 1, an answer being final."""
    return batches.sequence_check(table(spark, sf_dir, "conversations").withColumn("n", F.col("turn") + 1), ["conv_id"], "n", F.col("role") == "assistant")


@query("SELECT conv_id, min(turn)::BIGINT AS first_place, max(turn)::BIGINT AS last_place, count(*) AS n, max(turn) - min(turn) + 1 = count(*) AND count(DISTINCT turn) = count(*) AS contiguous FROM conversations GROUP BY conv_id")
def batch_contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-07."""
    return batches.contiguous(table(spark, sf_dir, "conversations"), ["conv_id"], "turn")


@query("SELECT doc_id, m AS first_row FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS m FROM documents) WHERE doc_id > m")
def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-08."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    return batches.repeats(docs, "digest", "doc_id").select("doc_id", "first_row")


#: Values of a classifier record made of a document and its label, as text that both engines read.
RECORD_SQL = {
    "pmid": "CASE WHEN doc_id % 11 = 0 THEN concat('x', CAST(doc_id AS STRING)) ELSE CAST(doc_id AS STRING) END",
    "disease": "CASE WHEN toxic = 1 THEN 'cancer' ELSE 'unclear' END",
    "study": "CASE lang WHEN 'en' THEN 'review' WHEN 'de' THEN 'method' WHEN 'fr' THEN 'commentary' ELSE 'essay' END",
    "primary_contribution": "'other'",
    "new_experimental_data": "CASE WHEN quality = 1 THEN 'none' ELSE NULL END",
    "public_data_reuse": "'minor'",
    "relevance": "CASE WHEN quality = 1 THEN 'YES' ELSE 'PERHAPS' END",
    "rationale": "CASE WHEN n_chars >= 500 THEN 'long enough' ELSE ' ' END",
    "model": "'m'", "prompt_version": "'v1'", "screened_at": "CASE WHEN doc_id % 7 = 0 THEN 'yesterday' ELSE '2026-09-01T00:00:00Z' END",
}
NUMBERS_SQL = {"computational_centrality": "CAST(doc_id % 5 AS INT)", "confidence": "CAST(n_chars AS DOUBLE) / 3000"}


def _record_rules() -> list[tuple[str, str]]:
    """Every rule of a record with its condition on the columns above, for the SQL."""
    rules = [(f"Invalid {name}", f"{name} IN ({', '.join(repr(v) for v in values)})") for name, values in RECORD_ENUMS.items()]
    rules += [("data_modalities must be a non-empty unique list", "doc_id % 4 NOT IN (0, 1)"), ("Invalid data modality", "doc_id % 4 <> 2"), ("computational_centrality must be an integer from 0 to 3", "computational_centrality BETWEEN 0 AND 3"), ("confidence must be from 0 to 1", "confidence BETWEEN 0 AND 1")]
    rules += [(f"{name} must be a non-empty string", f"trim({name}) <> ''") for name in ("pmid", "rationale", "model", "prompt_version", "screened_at")]
    return [*rules, ("pmid must contain only digits", "doc_id % 11 <> 0"), ("screened_at must be an ISO date-time", "doc_id % 7 <> 0")]


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as classifier records, many with one error or more; the list of modalities is empty, doubled, unknown or good."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    lists = [F.array().cast("array<string>"), F.array(F.lit(MODALITIES[0]), F.lit(MODALITIES[0])), F.array(F.lit("unheard of")), F.array(F.lit(MODALITIES[0]), F.lit(MODALITIES[1]))]
    kinds = F.when(F.col("doc_id") % 4 == 0, lists[0]).when(F.col("doc_id") % 4 == 1, lists[1]).when(F.col("doc_id") % 4 == 2, lists[2]).otherwise(lists[3])
    return rows.select("doc_id", *[F.expr(x).alias(c) for c, x in (RECORD_SQL | NUMBERS_SQL).items()], kinds.alias("data_modalities"))


RECORDS = "rec AS (SELECT doc_id, " + ", ".join(f"{x} AS {c}" for c, x in (RECORD_SQL | NUMBERS_SQL).items()) + " FROM documents JOIN labels USING (doc_id)), bad AS (SELECT *, [x for x in [" + ", ".join(f"CASE WHEN NOT coalesce({sql}, false) THEN '{m}' END" for m, sql in _record_rules()) + "] if x IS NOT NULL] AS v FROM rec)"


@query(f"WITH {RECORDS} SELECT doc_id, array_to_string(v, '; ') AS violations, v[1] AS first_error FROM bad")
def validate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-01, SET-04: the rules of a classifier record, all of them and the first that is broken."""
    return validate.validate_records(records(spark, sf_dir)).select("doc_id", F.array_join("violations", "; ").alias("violations"), "first_error")


@query("SELECT doc_id, array_to_string([x for x in [CASE WHEN toxic = 1 AND quality = 0 THEN 'status' END, CASE WHEN quality = 0 THEN 'scope' END] if x IS NOT NULL], ';') AS broken FROM labels WHERE quality = 0")
def broken_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section 1.4: the check constraints of the coverage table, on labels."""
    rows = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "annual").otherwise("monthly").alias("scope"), F.when((F.col("toxic") == 1) & (F.col("quality") == 0), "unknown").otherwise("match").alias("status"))
    named = checks("backfill_coverage_checks")
    return validate.broken_constraints(rows, {k: named[k] for k in ("status", "scope")}, ["doc_id"]).select("doc_id", F.array_join("broken", ";").alias("broken"))


def written(df: DataFrame, name: str) -> str:
    """Rows of one text column as text files in the shared folder, for the readers of files; the path."""
    path = f"{shared_dir(df.sparkSession)}/strataflow/{name}-{uuid.uuid4().hex}"
    df.write.text(path)
    return f"{path}/part-*"


def record_lines(df: DataFrame, *but: str) -> DataFrame:
    """Records as lines of JSON, less some of their fields."""
    fields = [f for f in df.columns if f not in ("doc_id", *but)]
    return df.select("doc_id", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


@query(f"WITH {RECORDS} SELECT pmid, model FROM bad WHERE len(v) = 0")
def jsonl_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-09, FN-26: records written as JSON lines and read back line by line, whatever tasks read them; those without an error."""
    return read_records(spark, written(record_lines(records(spark, sf_dir)).select("value"), "lines")).filter("error is null").select("pmid", "model")


@query(f"""WITH {RECORDS}, good AS (SELECT * FROM bad WHERE len(v) = 0), twice AS (SELECT pmid, model, prompt_version, screened_at, count(*) AS n FROM good GROUP BY ALL)
SELECT pmid, model, rank() OVER (ORDER BY pmid)::BIGINT AS place, true AS has_id, 0::BIGINT AS orphans FROM twice""")
def import_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-09, UPS-05, FLT-07: files of valid lines, with every line twice, imported into a store whose articles they refer to; the rows it then has."""
    good = validate.validate_records(records(spark, sf_dir)).filter("first_error is null").drop("violations", "first_error")
    lines = record_lines(good).select("value")
    store = Store(spark, f"{shared_dir(spark)}/strataflow/store-{uuid.uuid4().hex}")
    names = store.frame("articles", []).columns
    store.append("articles", good.select("pmid").distinct().select(*[F.col(c) if c == "pmid" else F.lit(None).cast(store.frame("articles", []).schema[c].dataType).alias(c) for c in names]))
    import_file(store, written(lines.union(lines), "import"))
    rows = store.read("llm_screens")
    lone = upsert.orphans(rows, store.read("articles"), ["pmid"]).agg(F.count("*").alias("orphans"))
    placed = batches.global_position(rows.select("pmid", "model", "id"), [F.asc("pmid")])
    return placed.crossJoin(F.broadcast(lone)).select("pmid", "model", F.col("position").alias("place"), F.col("id").isNotNull().alias("has_id"), "orphans")


@query(f"WITH {RECORDS} SELECT split_part(v[1], ' ', 1) AS said, count(*) AS n FROM bad WHERE len(v) > 0 GROUP BY 1")
def jsonl_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-01, SRC-09: first words of the first error of each line that has one."""
    errors = read_records(spark, written(record_lines(records(spark, sf_dir)).select("value"), "lines")).filter("error is not null")
    return errors.groupBy(F.element_at(F.split("error", " "), 1).alias("said")).agg(F.count("*").alias("n"))


@query(f"""WITH {RECORDS}, own AS (SELECT doc_id, [x for x in v if NOT regexp_matches(x, '^(model|prompt_version|screened_at) ')] AS v FROM bad),
said AS (SELECT split_part(v[1], ' ', 1) AS said FROM own WHERE len(v) > 0 UNION ALL SELECT 'no' AS said FROM own WHERE doc_id % 3 = 0 UNION ALL SELECT 'valid' AS said FROM own WHERE len(v) = 0)
SELECT said, count(*) AS n FROM said GROUP BY 1""")
def answer_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-10, VAL-02: raw answers without provenance, read strictly: blank lines are lines, and no JSON."""
    lines = record_lines(records(spark, sf_dir), "model", "prompt_version", "screened_at").select(F.concat("value", F.when(F.col("doc_id") % 3 == 0, "\n").otherwise("")).alias("value"))
    got = read_records(spark, written(lines, "answers"), provenance=False, skip_blank=False)
    return got.groupBy(F.when(F.col("error").isNull(), "valid").otherwise(F.element_at(F.split("error", " "), 1)).alias("said")).agg(F.count("*").alias("n"))


@query(f"""WITH {RECORDS}, own AS (SELECT [x for x in v if NOT regexp_matches(x, '^(model|prompt_version|screened_at) ')] AS v FROM bad),
good AS (SELECT count(*) FILTER (len(v) = 0) AS n FROM own) SELECT 'valid' AS said, n FROM good UNION ALL SELECT 'screened_at must be an ISO date-time' AS said, n FROM good""")
def provenance_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-03, FN-14: valid answers with provenance added and validated again, once with a time and once with none."""
    lines = record_lines(records(spark, sf_dir), "model", "prompt_version", "screened_at").select("value")
    good = read_records(spark, written(lines, "answers"), provenance=False, skip_blank=False).filter("error is null").drop("path", "line", "error")
    both = [validate.validate_records(validate.with_provenance(good, "m", "v1", when)) for when in ("2026-01-02T03:04:05Z", "some day")]
    return both[0].unionByName(both[1]).groupBy(F.coalesce("first_error", F.lit("valid")).alias("said")).agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, string_agg(said, ',' ORDER BY first) AS modes FROM (SELECT l_orderkey, said, min(place) AS first FROM (SELECT l_orderkey, l_returnflag || l_linestatus AS said, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag || l_linestatus) AS place FROM lineitem WHERE l_linenumber % 4 <> 0) GROUP BY ALL) GROUP BY l_orderkey")
def ordered_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-23: the flags of each order's lines, each once and in the order in which they come, empty ones left out."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_linenumber") % 4 == 0, "").otherwise(F.concat("l_returnflag", "l_linestatus")).alias("mode"))
    listed = rows.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "mode"))), lambda x: x["mode"]).alias("modes"))
    return listed.select("l_orderkey", F.array_join(ordered_distinct(F.col("modes")), ",").alias("modes")).filter("modes <> ''")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS pmid, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '10.1000/ord.' || o_orderkey END AS doi, 'Order & ' || trim(o_orderpriority) || ' now' AS title,
CASE o_orderkey % 2 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y') END AS publication_date, CASE o_orderkey % 2 WHEN 0 THEN 'day' ELSE 'year' END AS publication_date_precision, year(o_orderdate)::INT AS publication_year,
'Journal Article;Order' AS article_types, 'BACKGROUND: One2' || chr(10) || 'Two' AS abstract FROM orders WHERE o_orderkey % 5 <> 0""")
def xml_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-08, FN-01, FN-03: orders as marked-up records and read back; those without an id are left out."""
    day, key = F.col("o_orderdate"), F.col("o_orderkey").cast("string")
    odd = F.col("o_orderkey") % 2 == 1
    date_ = F.when(odd, F.concat(F.lit("<MedlineDate>"), F.date_format(day, "yyyy"), F.lit(" Winter</MedlineDate>"))).otherwise(F.concat(F.lit("<Year>"), F.date_format(day, "yyyy"), F.lit("</Year><Month>"), F.date_format(day, "MMM"), F.lit("</Month><Day>"), F.date_format(day, "d"), F.lit("</Day>")))
    doi = F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit('<PubmedData><ArticleIdList><ArticleId IdType="doi">https://doi.org/10.1000/ORD.'), key, F.lit(".</ArticleId></ArticleIdList></PubmedData>")))
    pmid = F.when(F.col("o_orderkey") % 5 == 0, F.lit(" ")).otherwise(key)
    xml = F.concat(
        F.lit("<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>"), pmid, F.lit("</PMID><Article><Journal><JournalIssue><PubDate>"), date_, F.lit("</PubDate></JournalIssue></Journal><ArticleTitle>Order &amp; <i>"), F.trim("o_orderpriority"),
        F.lit('</i>\n  now</ArticleTitle><Abstract><AbstractText Label="BACKGROUND">One<sub>2</sub></AbstractText><AbstractText>Two</AbstractText></Abstract><PublicationTypeList><PublicationType>Journal Article</PublicationType><PublicationType>Order</PublicationType><PublicationType>Journal Article</PublicationType></PublicationTypeList></Article></MedlineCitation>'),
        doi, F.lit("</PubmedArticle></PubmedArticleSet>"),
    )
    made = parse_records(table(spark, sf_dir, "orders").select(xml.cast("binary").alias("content")))
    return made.select("pmid", "doi", "title", "publication_date", "publication_date_precision", "publication_year", F.array_join("article_types", ";").alias("article_types"), "abstract")


@query("SELECT column_name AS name, CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' ELSE lower(data_type) END AS type, (ordinal_position)::INT AS position FROM information_schema.columns WHERE table_name = 'documents'")
def table_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-14."""
    return info_of(table(spark, sf_dir, "documents")).select("name", "type", "position")


@query(f"""WITH m AS (SELECT doc_id, [{', '.join(repr(x) for x in FULL_TEXT_STATUSES)}, 'lost'][CAST(doc_id % {len(FULL_TEXT_STATUSES) + 1} + 1 AS INT)] AS status, n_chars - 100 AS bytes FROM documents)
SELECT doc_id, array_to_string([x for x in [CASE WHEN status = 'lost' THEN 'status' END, CASE WHEN bytes < 0 THEN 'bytes' END] if x IS NOT NULL], ';') AS broken FROM m WHERE status = 'lost' OR bytes < 0""")
def full_text_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-12: manifest rows that break a check, with the names of the broken ones."""
    states = F.array(*map(F.lit, (*FULL_TEXT_STATUSES, "lost")))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("pmid"), F.get(states, (F.col("doc_id") % (len(FULL_TEXT_STATUSES) + 1)).cast("int")).alias("status"), (F.col("n_chars") - 100).alias("bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.lit("not_checked").alias("si_status"))
    return validate.broken_constraints(rows, checks("full_text_manifest"), ["doc_id"]).select("doc_id", F.array_join("broken", ";").alias("broken"))


@query("""WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents) SELECT (n // 100)::BIGINT AS batch_no, count(*) AS record_count, min(doc_id) AS first_key, max(doc_id) AS last_key,
substring(sha256('corpus' || chr(10) || 'v1' || chr(10) || string_agg(CAST(doc_id AS VARCHAR), chr(10) ORDER BY n)), 1, 24) AS batch_id FROM p GROUP BY 1""")
def corpus_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-11: the whole corpus in batches of at most 100, each with its manifest."""
    placed = batches.corpus_batches(table(spark, sf_dir, "documents").select("doc_id"), [F.asc("doc_id")], 100, "doc_id")
    made = batches.batch_manifests(placed, "corpus", "v1", "doc_id")
    return made.select("batch_no", "record_count", F.element_at("ordered_keys", 1).cast("long").alias("first_key"), F.element_at("ordered_keys", -1).cast("long").alias("last_key"), "batch_id")


@query("""SELECT page_id, CASE WHEN page_id % 11 = 0 THEN 'missing' WHEN page_id % 7 = 0 THEN 'changed' WHEN page_id % 5 = 0 THEN 'given twice' END AS problem FROM pages
WHERE page_id % 11 = 0 OR page_id % 7 = 0 OR page_id % 5 = 0 UNION ALL SELECT -1 - page_id AS page_id, 'given twice' AS problem FROM pages WHERE page_id % 5 = 0 AND page_id % 7 <> 0 AND page_id % 11 <> 0""")
def ledger_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VAL-08, SNK-01, FN-10: executors write every page to a file; a ledger that misses, misquotes or repeats some is held against the files."""
    pages = table(spark, sf_dir, "pages").select(F.lit("r").alias("run_id"), F.col("page_id").cast("long").alias("retstart"), F.col("html").cast("binary").alias("content"), F.lit(None).cast("string").alias("error"))
    k = F.col("retstart")
    written_ = stored(write_pages(pages, f"{shared_dir(spark)}/strataflow/files-{uuid.uuid4().hex}"), "ledger")
    lost, misquoted = k % 11 == 0, k % 7 == 0
    ledger = written_.select(k.alias("page_id"), F.when(lost, F.concat("path", F.lit(".gone"))).otherwise(F.col("path")).alias("path"), F.when(misquoted, F.sha2("sha256", 256)).otherwise(F.col("sha256")).alias("sha256"))
    again = ledger.filter((F.col("page_id") % 5 == 0) & (F.col("page_id") % 7 != 0) & (F.col("page_id") % 11 != 0)).withColumn("page_id", -1 - F.col("page_id"))
    return validate.file_problems(file_digests(ledger.union(again), "path"), "path", "sha256").select("page_id", "problem")


@query("""WITH w AS (SELECT DISTINCT lower(p_name) AS t FROM part WHERE p_partkey % 9 = 0), x AS (SELECT DISTINCT lower(p_name) AS t FROM part WHERE p_partkey % 4 = 0), f AS (SELECT DISTINCT p_brand AS b FROM part WHERE p_brand LIKE '%3')
SELECT p_partkey, CASE WHEN w.t IS NOT NULL THEN 'include' WHEN x.t IS NOT NULL OR f.b IS NOT NULL THEN 'exclude' ELSE 'include' END AS action,
CASE WHEN w.t IS NOT NULL THEN 'whitelisted' WHEN x.t IS NOT NULL THEN 'title is excluded' WHEN f.b IS NOT NULL THEN 'publisher family ' || f.b ELSE 'no rule' END AS reason
FROM part LEFT JOIN w ON w.t = lower(p_name) LEFT JOIN x ON x.t = lower(p_name) LEFT JOIN f ON f.b = p_brand""")
def journal_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-15, STA-13: parts as journals and brands as publishers; titles and families that are left out, and titles that stay in any case."""
    part = table(spark, sf_dir, "part")
    titles = part.select("p_partkey", F.col("p_name").alias("title"), F.col("p_brand").alias("publisher"))
    rules = part.filter("p_partkey % 4 = 0").select(F.lit("title").alias("kind"), F.upper("p_name").alias("name")).union(part.filter("p_brand like '%3'").select(F.lit("publisher"), "p_brand").distinct())
    return journal_actions(titles, rules, part.filter("p_partkey % 9 = 0").select(F.initcap("p_name").alias("title")), whitelist_only=False).select("p_partkey", "action", "reason")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-26, PRJ-02."""
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("SELECT doc_id, sha256(text) AS sha256, strlen(text)::BIGINT AS byte_size, sha256('ledger:' || doc_id) AS hash_rank FROM documents")
def hash_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-08, FN-10."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.octet_length("text").cast("long").alias("byte_size"), hash_rank("ledger", F.col("doc_id")).alias("hash_rank"))


@query(r"""WITH u AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN ' HTTPS://dx.doi.org/' WHEN 1 THEN 'DOI:  ' WHEN 2 THEN '' ELSE ' . ' END AS head, url FROM pages)
SELECT page_id, CASE page_id % 4 WHEN 3 THEN nullif('. ' || lower(url), '') ELSE lower(url) END AS normal FROM u""")
def normalize_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-01, FN-16: identifiers behind a resolver, a prefix or nothing, with stops and spaces behind them."""
    head = F.when(F.col("page_id") % 4 == 0, " HTTPS://dx.doi.org/").when(F.col("page_id") % 4 == 1, "DOI:  ").when(F.col("page_id") % 4 == 2, "").otherwise(" . ")
    return table(spark, sf_dir, "pages").select("page_id", normalize_doi(F.concat(head, "url", F.lit(" . . "))).alias("normal"))


@query("SELECT page_id, trim(regexp_replace(regexp_extract(html, '<title>([^<]*)', 1), '\\s+', ' ', 'g')) AS title, regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) AS lang, length(html)::BIGINT AS n FROM pages")
def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-02: fields of a marked-up page."""
    html = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", collapse_space(F.regexp_extract(html, "<title>([^<]*)", 1)).alias("title"), F.regexp_extract(html, '<html lang="([a-z]+)"', 1).alias("lang"), F.length(html).cast("long").alias("n"))


@query("""WITH d AS (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, o_orderkey % 4 AS k FROM orders)
SELECT o_orderkey, CASE k WHEN 0 THEN printf('%04d', y) WHEN 1 THEN printf('%04d-%02d', y, m) WHEN 2 THEN printf('%04d-%02d-%02d', y, m, d) ELSE printf('%04d', y) END AS value, CASE k WHEN 0 THEN 'year' WHEN 1 THEN 'month' WHEN 2 THEN 'day' ELSE 'year' END AS precision, y::INT AS year,
CAST(greatest(make_date(y, 1, 1), DATE '1996-03-01') AS VARCHAR) AS period_start, CAST(least(make_date(y, 12, 31), DATE '1999-06-30') AS VARCHAR) AS period_end, CAST(DATE '1996-01-01' + CAST(floor((make_date(y, m, d) - DATE '1996-01-01') / 2.0) AS INT) AS VARCHAR) AS middle FROM d""")
def partial_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-03, FN-04, FN-18, FN-20, FN-24: all orders; the midpoint of one before its start is rounded down, to the earlier day."""
    k, day = F.col("o_orderkey") % 4, F.col("o_orderdate")
    text = lambda f: F.date_format(day, f)
    parts = partial_date(F.when(k < 3, text("yyyy")), F.when(k == 2, text("M")).when(k == 1, text("MMM")), F.when(k == 2, text("d")), F.when(k == 3, F.concat(text("yyyy"), F.lit(" Winter"))))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", parts.alias("p"))
    start, end = year_bounds(F.year(day), F.lit("1996-03-01").cast("date"), F.lit("1999-06-30").cast("date"))
    return as_text(rows.select("o_orderkey", F.col("p.value").alias("value"), F.col("p.precision").alias("precision"), F.col("p.year").alias("year"), start.alias("period_start"), end.alias("period_end"), midpoint(F.lit("1996-01-01").cast("date"), day.cast("date")).alias("middle")))


@query("""SELECT (SELECT count(*) FROM ((SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents))) = 0 AS labels_in_documents,
(SELECT count(*) FROM ((SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels))) + (SELECT count(*) FROM ((SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents))) = 0 AS same_ids,
(SELECT count(*) FROM ((SELECT n_regionkey FROM nation EXCEPT SELECT r_regionkey FROM region))) + (SELECT count(*) FROM ((SELECT r_regionkey FROM region EXCEPT SELECT n_regionkey FROM nation))) = 0 AS same_regions,
(SELECT count(*) FROM (SELECT text FROM documents INTERSECT SELECT text FROM benchmark)) = 0 AS disjoint_from_benchmark, (SELECT count(*) FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)) = 0 AS disjoint_from_labels, (SELECT count(*) = count(DISTINCT doc_id) FROM documents) AS unique_ids""")
def set_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-02, SET-05, SET-06."""
    docs, labels, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), table(spark, sf_dir, "benchmark")
    regions = table(spark, sf_dir, "region").select("r_regionkey")
    said = (
        not upsert.orphans(labels.select("doc_id"), docs, ["doc_id"]).limit(1).count(),
        validate.same_set(docs.select("doc_id"), labels.select("doc_id")),
        validate.same_set(table(spark, sf_dir, "nation").select("n_regionkey"), regions),
        validate.disjoint(docs.select("text"), bench.select("text")),
        validate.disjoint(docs.select("doc_id"), labels.select("doc_id")),
    )
    names = "labels_in_documents boolean, same_ids boolean, same_regions boolean, disjoint_from_benchmark boolean, disjoint_from_labels boolean"
    unique = docs.groupBy("doc_id").count().agg((F.coalesce(F.max("count"), F.lit(1)) == 1).alias("unique_ids"))
    return spark.createDataFrame([said], names).crossJoin(F.broadcast(unique))


CELLS = f"""WITH {SCREENED}, c AS (SELECT s.lang, count(*) FILTER (candidate_priority AND quality = 1) AS tp, count(*) FILTER (candidate_priority AND quality = 0) AS fp, count(*) FILTER (NOT candidate_priority AND quality = 1) AS fn, count(*) FILTER (NOT candidate_priority AND quality = 0) AS tn FROM s JOIN labels USING (doc_id) GROUP BY s.lang),
n AS (SELECT lang AS big_lang, count(*) AS big FROM documents GROUP BY lang)"""


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = screened(spark, sf_dir).select("doc_id", "lang", "candidate_priority").join(table(spark, sf_dir, "labels"), "doc_id")
    return stats.confusion(rows, ["lang"], F.col("candidate_priority"), F.col("quality") == 1)


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("population_size"))


@query(f"{CELLS}, w AS (SELECT round(sum(big::DOUBLE / (tp + fp + fn + tn) * tp) / sum(big::DOUBLE / (tp + fp + fn + tn) * (tp + fn)), 6) AS weighted_recall FROM c JOIN n ON c.lang IS NOT DISTINCT FROM n.big_lang) SELECT w.weighted_recall, round(sum(tp)::DOUBLE / sum(tp + fn), 6) AS recall, round(sum(tp)::DOUBLE / sum(tp + fp), 6) AS precision, sum(fn)::BIGINT AS false_negatives, round(sum(fn)::DOUBLE / sum(fn + tn), 6) AS false_negative_rate FROM c, w GROUP BY ALL")
def weighted_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-01, STA-02, STA-05."""
    c = cells(spark, sf_dir)
    return stats.weighted_recall(c, sizes(spark, sf_dir), "lang").crossJoin(F.broadcast(stats.recall_precision(c)))


@query(f"""{CELLS}, w AS (SELECT sum(big::DOUBLE / (tp + fp + fn + tn) * tp) / sum(big::DOUBLE / (tp + fp + fn + tn) * (tp + fn)) AS r FROM c JOIN n ON c.lang IS NOT DISTINCT FROM n.big_lang),
p AS (SELECT min(tp::DOUBLE / (tp + fn)) AS worst FROM c WHERE tp + fn >= 20), d AS (SELECT count(DISTINCT doc_id)::DOUBLE / (SELECT count(DISTINCT doc_id) FROM documents) AS coverage FROM labels)
SELECT coverage >= 1 AND r >= 0.95 AND coalesce(worst, 1) >= 0.9 AS accepted, true AS perfect_is_accepted, round(coverage, 6) AS coverage, round(worst, 6) AS worst FROM w, p, d""")
def acceptance_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-09: coverage, weighted recall and the recall of the worst stratum with enough positives against the limits."""
    c = cells(spark, sf_dir)
    recall = stats.weighted_recall(c, sizes(spark, sf_dir), "lang")
    worst = stats.stratum_recall(c, "lang").agg(F.min("recall").alias("worst"))
    ids = lambda t: table(spark, sf_dir, t).agg(F.countDistinct("doc_id").alias(t))
    one = recall.crossJoin(F.broadcast(worst)).crossJoin(F.broadcast(ids("labels"))).crossJoin(F.broadcast(ids("documents"))).withColumn("coverage", F.col("labels") / F.col("documents"))
    return one.select(stats.gate(F.col("coverage"), F.col("weighted_recall"), F.col("worst")).alias("accepted"), stats.gate(F.lit(1.0), F.lit(0.95), F.lit(None).cast("double")).alias("perfect_is_accepted"), F.round("coverage", 6).alias("coverage"), F.round("worst", 6).alias("worst"))


@query("SELECT count(*) AS n, round(avg(CASE WHEN quality IS NOT DISTINCT FROM toxic THEN 1.0 ELSE 0.0 END), 6) AS exact, round(avg(CASE WHEN coalesce(abs(quality - toxic) <= 1, false) THEN 1.0 ELSE 0.0 END), 6) AS within_one FROM labels")
def agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-06, STA-08."""
    return stats.agreement(table(spark, sf_dir, "labels"), [("exact", "quality", "toxic")], [("within_one", "quality", "toxic")])


DECIDED = "dec AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'YES' WHEN toxic = 1 THEN 'MAYBE' ELSE 'NO' END AS relevance FROM labels), n AS (SELECT DISTINCT doc_id, sha256('audit:' || doc_id) AS hash_rank FROM dec WHERE relevance = 'NO'), c AS (SELECT *, row_number() OVER (ORDER BY hash_rank, doc_id) AS rn, count(*) OVER () AS t FROM n)"


@query(f"WITH {DECIDED} SELECT doc_id, relevance AS reason FROM dec WHERE relevance <> 'NO' UNION ALL SELECT doc_id, 'NO sample' AS reason FROM c WHERE rn <= ceil(t * CAST(0.1 AS DOUBLE))")
def human_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-10."""
    decided = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "YES").when(F.col("toxic") == 1, "MAYBE").otherwise("NO").alias("relevance"))
    return sample.human_queue(decided, "doc_id", "relevance", 0.1, "audit")


@query("SELECT doc_id, CASE WHEN quality IS NOT DISTINCT FROM toxic THEN quality ELSE (doc_id % 2)::INT END AS relevance FROM labels")
def adjudicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-08: two raters of each label, and a third whose word counts where they differ."""
    labels = table(spark, sf_dir, "labels")
    said = F.array(F.struct(F.lit("r1").alias("reviewer"), F.col("quality").alias("relevance")), F.struct(F.lit("r2").alias("reviewer"), F.col("toxic").alias("relevance")), F.struct(F.lit("r3").alias("reviewer"), (F.col("doc_id") % 2).cast("int").alias("relevance")))
    return stats.adjudicated(labels.select("doc_id", F.explode(said).alias("s")).select("doc_id", "s.*"), "doc_id", "reviewer", ["relevance"])


@query("WITH p AS (SELECT conv_id, arg_min(role = 'assistant', turn) AS f, max(role = 'assistant') AS d, count(*) AS n FROM conversations GROUP BY conv_id) SELECT count(*) AS batches, sum(n)::BIGINT AS attempts, round(avg(f::INT), 6) AS first_attempt_validity, round(avg(d::INT), 6) AS completion, round(avg((n > 1)::INT), 6) AS retry_rate FROM p")
def retry_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-07."""
    return batches.retry_metrics(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.col("role") == "assistant")


@query("SELECT substring(sha256('s' || chr(10) || 'v1' || chr(10) || string_agg(CAST(l_linenumber AS VARCHAR), chr(10) ORDER BY l_linenumber)), 1, 24) AS batch_id, l_orderkey FROM lineitem GROUP BY l_orderkey")
def batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-09, AGG-09: an id from each order's ordered lines."""
    listed = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("x"))
    return listed.select(batch_id(F.lit("s"), F.lit("v1"), F.transform("x", lambda v: v.cast("string"))).alias("batch_id"), "l_orderkey")


def _tail(at: str, p: str) -> str:
    """Chance of ``at`` or more successes of n, in SQL."""
    return f"list_sum(list_transform(range({at}, n + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln(1 - {p}))))"


@query(f"""WITH RECURSIVE {CELLS.removeprefix('WITH ')}, x AS (SELECT lang, tp AS k, tp + fn AS n FROM c),
b AS (SELECT lang, k, n, 0 AS step, 0.0::DOUBLE AS l1, 1.0::DOUBLE AS l2, 0.0::DOUBLE AS u1, 1.0::DOUBLE AS u2 FROM x
UNION ALL SELECT lang, k, n, step + 1, CASE WHEN lo < 0.025 THEN (l1 + l2) / 2 ELSE l1 END, CASE WHEN lo < 0.025 THEN l2 ELSE (l1 + l2) / 2 END, CASE WHEN hi < 0.975 THEN (u1 + u2) / 2 ELSE u1 END, CASE WHEN hi < 0.975 THEN u2 ELSE (u1 + u2) / 2 END
FROM (SELECT *, {_tail("k", "((l1 + l2) / 2)")} AS lo, {_tail("k + 1", "((u1 + u2) / 2)")} AS hi FROM b WHERE step < 50))
SELECT lang, n AS positives, CASE WHEN n >= 20 THEN round(k::DOUBLE / n, 6) END AS recall, n < 20 AS underpowered, round(CASE WHEN k = 0 THEN 0 ELSE (l1 + l2) / 2 END, 6) AS lower, round(CASE WHEN k = n THEN 1 ELSE (u1 + u2) / 2 END, 6) AS upper FROM b WHERE step = 50""")
def exact_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-04: Clopper-Pearson intervals in column functions; in SQL by a recursive query."""
    return stats.stratum_recall(cells(spark, sf_dir), "lang")


@query()
def bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA-03: 10,000 seeded replicates."""
    return stats.bootstrap_recall(cells(spark, sf_dir), sizes(spark, sf_dir), "lang", 10_000, 7)
