"""Historical backfills: plan, enumerate, reconcile, resume (PLN-02..04, REC-02, REC-03)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, date, datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

from strataflow.functions.scalars import coverage_status
from strataflow.operators import coverage
from strataflow.operators.scratch import discard, stored
from strataflow.operators.slices import plan_slices_by_level
from strataflow.operators.upsert import first_seen
from strataflow.plans.store import Store
from strataflow.schemas import TABLES
from strataflow.sinks.files import read_written, write_pages
from strataflow.sources.config import Journal, Registry
from strataflow.sources.paged import Source
from strataflow.sources.paged_source import LANES, page_requests, read_counts, read_pages
from strataflow.sources.xml_records import flaw_of, parse_records

#: Records that the source gives at most for one query.
MOST_RESULTS = 9999


class IncompleteRun(RuntimeError):
    """Counts of an enumeration or a backfill do not agree."""


def now() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds").replace("+00:00", "Z")


def precise_now() -> str:
    """The same to the microsecond (FN-13)."""
    return datetime.now(UTC).isoformat(timespec="microseconds").replace("+00:00", "Z")


def enumerate_slices(store: Store, source: Source, registry: Registry, slices: DataFrame, raw: str | Path, size: int = 200, clock: Callable[[], str] = now, lanes: int = LANES) -> DataFrame:
    """All slices at once: pages to raw files by the executors, then records, memberships and ledger in one transaction.

    ``slices`` has ``journal_key``, ``title``, ``slice_start``, ``slice_end``, ``records`` and ``handle`` as counted, and
    ``run_id``. Returns a run each: ``run_id``, ``journal_key``, ``slice_start``, ``slice_end``, ``status``, ``error``. A
    run is complete only if the source's count, the records fetched and the distinct ids agree and no page
    failed; the others are recorded as failed. Pages stay in any case. Later slices of a record, by journal and
    day, count over earlier ones, as if one had been fetched after the other.
    """
    began, place = clock(), {j.key: n for n, j in enumerate(registry.journals)}
    order = F.coalesce(*[F.when(F.col("journal_key") == k, n) for k, n in place.items()], F.lit(len(place)))
    runs = slices.select(
        "run_id", "journal_key", F.col("title").alias("journal_title"), F.lit(registry.version).alias("registry_version"), query_of("title", "slice_start", "slice_end").alias("query"),
        F.col("slice_start").alias("start_date"), F.col("slice_end").alias("end_date"), F.col("records").alias("expected_count"), *(F.lit(None).cast("bigint").alias(c) for c in ("fetched_count", "unique_count")),
        F.lit("running").alias("status"), F.lit(None).cast("string").alias("error"), F.lit(began).alias("started_at"), F.lit(None).cast("string").alias("completed_at"),
    )
    store.append("enumeration_runs", runs)
    asked = page_requests(slices.select("run_id", "journal_key", "title", "slice_start", "slice_end", "records", "handle"), size)
    ledger = stored(write_pages(read_pages(asked, source, size, lanes), raw, flaw_of), "ledger")
    good = read_written(ledger.filter("error is null").select("run_id", "journal_key", "slice_start", "retstart", "path", "byte_size", "sha256"))
    rows = stored(parse_records(good, batch="retstart", carry=("run_id", "journal_key", "slice_start")).withColumn("ordinal", F.col("batch") + F.col("place")).withColumn("journal_place", order), "parsed")
    found = rows.groupBy("run_id", F.col("batch").alias("retstart")).agg(F.count("*").alias("record_count"))
    written = ledger.filter("path is not null").join(found, ["run_id", "retstart"], "left")
    counted = written.select("run_id", "retstart", F.coalesce("record_count", F.lit(0)).cast("bigint").alias("record_count"), F.col("path").alias("raw_xml_path"), "byte_size", "sha256")
    with store.transaction():
        sources = rows.withColumns({"pubmed_url": F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), "pmid", F.lit("/")), "first_seen_run_id": F.col("run_id"), "last_seen_run_id": F.col("run_id"), "source_updated_at": F.lit(clock())})
        at = ("journal_place", "slice_start", "ordinal")
        articles = first_seen(sources.select(*_columns("articles"), *at), ["pmid"], at, ["first_seen_run_id"])
        store.upsert("articles", articles.select(*_columns("articles")), keep=["first_seen_run_id"])
        store.insert_ignore("enumeration_membership", rows.select("run_id", "pmid", "ordinal"), order=["ordinal"])
        store.append("enumeration_batches", counted)
    mine = slices.select("run_id")
    broken = ledger.filter("error is not null").groupBy("run_id").agg(F.min_by("error", "retstart").alias("page_error"))
    gate = coverage.run_gate(store.read("enumeration_batches").join(mine, "run_id", "left_semi"), store.read("enumeration_membership").join(mine, "run_id", "left_semi"), slices.select("run_id", F.col("records").alias("expected_count")))
    judged = slices.select("run_id", "journal_key", "slice_start", "slice_end").join(gate, "run_id").join(broken, "run_id", "left")
    said = F.format_string("%s: %d reported, %d fetched, %d distinct", "journal_key", "expected_count", "fetched_count", "unique_count")
    fine = (F.col("status") == "complete") & F.col("page_error").isNull()
    judged = stored(judged.withColumn("error", F.when(fine, F.lit(None)).otherwise(F.coalesce(F.concat("journal_key", F.lit(": "), "page_error"), said))).withColumn("status", F.when(fine, "complete").otherwise("failed")), "judged")
    done = runs.drop("fetched_count", "unique_count", "status", "error", "completed_at").join(judged.select("run_id", "fetched_count", "unique_count", "status", "error"), "run_id").withColumn("completed_at", F.lit(clock()))
    store.upsert("enumeration_runs", done.select(*_columns("enumeration_runs")))
    discard(ledger, rows)
    return judged.select("run_id", "journal_key", "slice_start", "slice_end", "status", "error")


def enumerate_journal(store: Store, source: Source, registry: Registry, journal: Journal, start: date, end: date, raw: str | Path, size: int = 200, clock: Callable[[], str] = now, lanes: int = LANES) -> dict:
    """One window of a journal, as ``enumerate_slices``; raises if the run is not complete. Returns its row."""
    if start > end:
        raise ValueError("the window ends before it starts")
    windows = store.spark.createDataFrame([(journal.key, journal.pubmed_title, start, end, uuid.uuid4().hex)], "journal_key string, title string, slice_start date, slice_end date, run_id string")
    counted = stored(read_counts(windows, source, lanes), "counted")
    run = counted.first()
    if run["error"]:
        raise IncompleteRun(f"{journal.key}: {run['error']}")
    enumerate_slices(store, source, registry, counted.drop("error"), raw, size, clock, lanes)
    discard(counted)
    done = store.read("enumeration_runs").filter(F.col("run_id") == run["run_id"]).first().asDict()
    if done["status"] != "complete":
        raise IncompleteRun(done["error"])
    return done


def query_of(title: str, start: str, end: str) -> Column:
    """``Window.query`` of columns."""
    return F.format_string('"%s"[jour] AND ("%s"[Date - Publication] : "%s"[Date - Publication])', F.replace(F.col(title), F.lit('"'), F.lit('\\"')), F.col(start).cast("string"), F.col(end).cast("string"))


def _columns(table: str) -> list[str]:
    from strataflow.sources.xml_records import _fields

    return [f.split(" ")[0] for f in _fields(TABLES[table])]


def _open(store: Store, registry: Registry, start: date, end: date, revision: str, resume: str | None, clock: Callable[[], str]) -> str:
    keys = sorted(j.key for j in registry.journals)
    if resume is None:
        ident = uuid.uuid4().hex
        with store.transaction():
            store.append("historical_backfills", [(ident, registry.version, start, end, revision, len(keys), "running", clock(), None)])
            store.append("historical_backfill_journals", [(ident, k, None, "pending", 0, None, None, None) for k in keys])
        return ident
    run = store.read("historical_backfills").filter(F.col("backfill_id") == resume).first()
    if run is None:
        raise ValueError(f"unknown backfill {resume}")
    had = sorted(r["journal_key"] for r in store.read("historical_backfill_journals").filter(F.col("backfill_id") == resume).collect())
    if (run["registry_version"], run["start_date"], run["end_date"], had) != (registry.version, start, end, keys):
        raise ValueError("a resumed backfill needs the same registry, window and journals")
    return resume


def run_backfill(store: Store, source: Source, registry: Registry, start: date, end: date, raw: str | Path, revision: str, size: int = 200, most: int = MOST_RESULTS, resume: str | None = None, clock: Callable[[], str] = now, lanes: int = LANES) -> dict:
    """All journals of a registry over a window, a stage at a time for all of them; those that fail are recorded and the others go on.

    Counting asks one question a level of halving for all open slices, enumeration is one plan over all pages, and
    coverage is checked by one aggregate: jobs do not grow with journals, slices or pages. A plan is compared with
    the stored one before anything is fetched. Complete journals and slices are skipped on resume. Only the full
    window's distinct union is a gate; years are recorded as diagnostics. Raises at the end if a journal failed.
    The driver holds the registry's journals and how each fared.
    """
    if start > end:
        raise ValueError("the window ends before it starts")
    ident = _open(store, registry, start, end, revision, resume, clock)
    mine = lambda table: store.read(table).filter(F.col("backfill_id") == ident)
    states = {r["journal_key"]: r.asDict() | {"status": "running", "attempt_count": r["attempt_count"] + 1, "error": None, "started_at": clock(), "completed_at": None} for r in mine("historical_backfill_journals").filter("status <> 'complete'").collect()}
    failed: dict[str, str] = {}
    if states:
        store.upsert("historical_backfill_journals", list(states.values()))
        try:
            _all_journals(store, source, registry, ident, sorted(states), start, end, raw, size, most, clock, lanes, failed)
        except Exception as exc:  # what stops a whole stage stops all journals that were in it
            failed |= {k: str(exc) for k in states if k not in failed}
            raise
        finally:
            store.upsert("historical_backfill_journals", [s | {"status": "failed" if k in failed else "complete", "error": failed.get(k), "completed_at": clock()} for k, s in states.items()])
            if failed:
                store.upsert("historical_backfills", [mine("historical_backfills").first().asDict() | {"status": "failed", "completed_at": clock()}])
    if failed:
        raise IncompleteRun(f"backfill {ident}: failed journals {', '.join(sorted(failed))}")
    store.upsert("historical_backfills", [mine("historical_backfills").first().asDict() | {"status": "complete", "completed_at": clock()}])
    return summary(store, ident)


def _all_journals(store: Store, source: Source, registry: Registry, ident: str, keys: list[str], start: date, end: date, raw: str | Path, size: int, most: int, clock: Callable[[], str], lanes: int, failed: dict[str, str]) -> None:
    """The stages of a backfill for the journals ``keys``; ``failed`` gets the first error of each that fails."""
    spark, slice_key = store.spark, ["journal_key", "slice_start", "slice_end"]

    def note(rows: DataFrame) -> None:
        """Errors (journal_key, error) of a stage, one a journal."""
        for r in rows.groupBy("journal_key").agg(F.min("error").alias("error")).collect():
            failed.setdefault(r["journal_key"], r["error"])

    left = lambda df: df.filter(~F.col("journal_key").isin(*failed)) if failed else df
    windows = spark.createDataFrame([(k, registry.by_key(k).pubmed_title, start, end) for k in keys], "journal_key string, title string, slice_start date, slice_end date")
    whole = stored(read_counts(windows, source, lanes), "whole")
    first = [whole]
    plan = plan_slices_by_level(windows, lambda w: first.pop() if first else read_counts(w, source, lanes), most, stuck=False)
    note(plan.filter("error is not null").select("journal_key", "error"))
    note(plan.filter(F.col("planned_count") > most).select("journal_key", F.format_string("%s: %d rows on %s, more than " + str(most), "journal_key", "planned_count", F.col("slice_start").cast("string")).alias("error")))
    table = lambda: store.read("historical_backfill_slices").filter(F.col("backfill_id") == ident)
    had = stored(table().filter(F.col("journal_key").isin(*keys)), "had")
    moved = left(plan).join(had.select("journal_key").distinct(), "journal_key", "left_semi").select(*slice_key, F.lit(1).alias("now")).join(had.select(*slice_key, F.lit(1).alias("then")), slice_key, "full").filter("now is null or then is null")
    note(left(moved).select("journal_key", F.concat("journal_key", F.lit(": the plan changed since the backfill began")).alias("error")))
    blank = {"backfill_id": F.lit(ident), "enumeration_run_id": F.lit(None).cast("string"), "status": F.lit("pending"), "attempt_count": F.lit(0), **{c: F.lit(None).cast("string") for c in ("error", "started_at", "completed_at")}}
    store.insert_ignore("historical_backfill_slices", left(plan).withColumns(blank).select(*_columns("historical_backfill_slices")))
    todo = left(plan).join(left(table()).filter("status <> 'complete'").select(*slice_key, "attempt_count"), slice_key)
    todo = stored(todo.select(*slice_key, "title", F.col("planned_count").alias("records"), "planned_count", "handle", F.replace(F.expr("uuid()"), F.lit("-")).alias("run_id"), (F.col("attempt_count") + 1).alias("attempt_count")), "todo")
    if todo.limit(1).count():
        began = clock()
        running = todo.withColumns(blank | {"status": F.lit("running"), "started_at": F.lit(began), "attempt_count": F.col("attempt_count")})
        store.upsert("historical_backfill_slices", running.select(*_columns("historical_backfill_slices")))
        judged = enumerate_slices(store, source, registry, todo.select(*slice_key, "title", "records", "handle", "run_id"), raw, size, clock, lanes)
        done = todo.join(judged.select("run_id", "status", "error"), "run_id")
        done = done.withColumns({"backfill_id": F.lit(ident), "enumeration_run_id": F.when(F.col("status") == "complete", F.col("run_id")), "started_at": F.lit(began), "completed_at": F.lit(clock())})
        store.upsert("historical_backfill_slices", done.select(*_columns("historical_backfill_slices")))
        note(judged.filter("status <> 'complete'").select("journal_key", "error"))
    good = [k for k in keys if k not in failed]
    if good:
        _check_coverage(store, source, ident, left(whole), start, end, clock, lanes, note)
    discard(whole, plan, had, todo)


def _check_coverage(store: Store, source: Source, ident: str, whole: DataFrame, start: date, end: date, clock: Callable[[], str], lanes: int, note: Callable[[DataFrame], None]) -> None:
    """Full windows and years of all journals of ``whole`` (counted windows) against the distinct members of their slices."""
    years = [(y, max(start, date(y, 1, 1)), min(end, date(y, 12, 31))) for y in range(start.year, end.year + 1)]
    bounds = store.spark.createDataFrame(years, "year int, slice_start date, slice_end date")
    asked = whole.select("journal_key", "title").crossJoin(F.broadcast(bounds))
    annual = stored(read_counts(asked, source, lanes), "annual")
    slices = store.read("historical_backfill_slices").filter(F.col("backfill_id") == ident).join(whole.select("journal_key"), "journal_key", "left_semi")
    members = store.read("enumeration_membership")
    union = coverage.union_count(slices, members, by=["journal_key"])
    done = slices.filter("status = 'complete'").select("journal_key", F.col("enumeration_run_id").alias("run_id"))
    by_year = done.join(members, "run_id").join(store.read("articles").select("pmid", "publication_year"), "pmid").groupBy("journal_key", F.col("publication_year").alias("year")).agg(F.countDistinct("pmid").alias("observed_count"))
    full = whole.join(union, "journal_key", "left").withColumn("scope", F.lit("full_window"))
    yearly = annual.filter("error is null").join(by_year, ["journal_key", "year"], "left").withColumn("scope", F.lit("annual"))
    columns = ("journal_key", "title", "slice_start", "slice_end", "records", "observed_count", "scope")
    both = full.select(*columns).unionByName(yearly.select(*columns))
    checks = both.select(
        F.lit(ident).alias("backfill_id"), "journal_key", "scope", F.col("slice_start").alias("period_start"), F.col("slice_end").alias("period_end"), query_of("title", "slice_start", "slice_end").alias("query"),
        F.col("records").alias("expected_count"), F.coalesce("observed_count", F.lit(0)).cast("bigint").alias("observed_count"),
    )
    checks = stored(checks.withColumn("status", coverage_status(F.col("expected_count"), F.col("observed_count"))).withColumn("checked_at", F.lit(clock())), "checks")
    store.upsert("backfill_coverage_checks", checks)
    note(annual.filter("error is not null").select("journal_key", "error"))
    off = checks.filter("scope = 'full_window' and status = 'discrepancy'")
    note(off.select("journal_key", F.format_string("%s: %d expected in the full window, %d distinct found", "journal_key", "expected_count", "observed_count").alias("error")))
    discard(annual, checks)


def summary(store: Store, ident: str) -> dict:
    mine = lambda table: store.read(table).filter(F.col("backfill_id") == ident)
    return coverage.backfill_summary(mine("historical_backfills"), mine("historical_backfill_journals"), mine("historical_backfill_slices"), store.read("enumeration_membership"), mine("backfill_coverage_checks")).first().asDict()


def report(store: Store, ident: str) -> dict:
    mine = lambda table: store.read(table).filter(F.col("backfill_id") == ident).drop("backfill_id")
    whole = store.read("historical_backfills").filter(F.col("backfill_id") == ident)
    one = coverage.backfill_summary(whole, mine("historical_backfill_journals"), mine("historical_backfill_slices"), store.read("enumeration_membership"), mine("backfill_coverage_checks"))
    return coverage.coverage_report(one, mine("historical_backfill_journals"), mine("backfill_coverage_checks"), mine("historical_backfill_slices"))
