from datetime import date, timedelta

import pytest

from strataflow.operators import slices
from strataflow.plans import backfill
from strataflow.plans.store import Store
from strataflow.sinks import files
from strataflow.sources.config import Journal, Registry
from strataflow.sources.paged import Window

REGISTRY = Registry("v1", "2023-01-01", (Journal("a", "Journal A", "Journal A", "Gold", (), 1.0), Journal("b", "Journal B", "Journal B", "Gold", (), 2.0)))


def article(pmid, year):
    return f"<PubmedArticle><MedlineCitation><PMID>{pmid}</PMID><Article><Journal><JournalIssue><PubDate><Year>{year}</Year></PubDate></JournalIssue></Journal><ArticleTitle>T</ArticleTitle></Article></MedlineCitation></PubmedArticle>"


class Fake:
    """Two journals; records are listed with a day each, one of B's on two days."""

    def __init__(self, broken=()):
        self.broken = set(broken)
        self.records = {"Journal A": [("91", date(2023, 5, 1))], "Journal B": [("92", date(2023, 6, 1)), ("93", date(2023, 6, 1)), ("93", date(2024, 2, 1))]}

    def ids(self, w):
        return sorted({p for p, d in self.records[w.title] if w.start <= d <= w.end})

    def opened(self, w):
        return len(self.ids(w)), f"history of {w.title}"

    def page(self, w, at, size, handle=None):
        assert handle == f"history of {w.title}"
        if w.title in self.broken:
            raise OSError("source down")
        return f"<s>{''.join(article(p, 2023) for p in self.ids(w)[at : at + size])}</s>".encode()


def test_backfill_fails_closed_and_resumes(spark, tmp_path):
    store = Store(spark, tmp_path / "db")
    run = lambda source, **more: backfill.run_backfill(store, source, REGISTRY, date(2023, 1, 1), date(2024, 12, 31), tmp_path / "raw", "rev", size=1, most=1 if more.pop("split", False) else 9999, **more)
    with pytest.raises(backfill.IncompleteRun, match="b"):
        run(Fake(broken=["Journal B"]))
    ident = store.read("historical_backfills").first()["backfill_id"]
    done = run(Fake(), resume=ident)
    assert (done["completed_journals"], done["failed_journals"], done["unique_articles"]) == (2, 0, 3)
    assert (done["full_window_checks"], done["full_window_discrepancies"], done["annual_checks"], done["annual_discrepancies"]) == (2, 0, 4, 1)
    attempts = {r["journal_key"]: r["attempt_count"] for r in store.read("historical_backfill_journals").collect()}
    assert attempts == {"a": 1, "b": 2}
    again = run(Fake(), resume=ident)
    assert again["unique_articles"] == 3 and store.read("enumeration_runs").filter("status = 'complete'").count() == 2
    with pytest.raises(ValueError, match="same registry"):
        backfill.run_backfill(store, Fake(), REGISTRY, date(2023, 1, 2), date(2024, 12, 31), tmp_path / "raw", "rev", resume=ident)
    report = backfill.report(store, ident)
    assert [j["journal_key"] for j in report["journals"]] == ["a", "b"] and len(report["annual_coverage"]) == 4 and len(report["slices"]) == 2


def test_repeated_enumeration_is_idempotent(spark, tmp_path):
    store = Store(spark, tmp_path / "db")
    for _ in range(2):
        backfill.enumerate_journal(store, Fake(), REGISTRY, REGISTRY.by_key("b"), date(2023, 1, 1), date(2024, 12, 31), tmp_path / "raw")
    assert store.read("articles").count() == 2 and store.read("enumeration_runs").count() == 2 and store.read("enumeration_membership").count() == 4
    firsts = {r["first_seen_run_id"] == r["last_seen_run_id"] for r in store.read("articles").collect()}
    assert firsts == {False}


def test_transaction_rolls_back(spark, tmp_path):
    store = Store(spark, tmp_path / "db")
    with pytest.raises(RuntimeError), store.transaction():
        store.append("schema_meta", [("x", "1")])
        raise RuntimeError
    assert [r["key"] for r in store.read("schema_meta").collect()] == ["schema_version"]


def test_all_slices_of_all_journals_are_one_plan(spark, tmp_path):
    """Jobs do not grow with journals or slices, and the result is that of one journal after the other."""
    many = Many()
    registry = Registry("v1", "2023-01-01", tuple(Journal(k, t, t, "Gold", (), float(n)) for n, (k, t) in enumerate(many.names)))
    store = Store(spark, tmp_path / "db")
    out = backfill.run_backfill(store, many, registry, date(2023, 1, 1), date(2023, 12, 31), tmp_path / "raw", "rev", size=3, most=4)
    assert (out["completed_journals"], out["unique_articles"], out["annual_discrepancies"]) == (5, 55, 0)
    plan = {(r["journal_key"], r["slice_start"], r["slice_end"], r["planned_count"]) for r in store.read("historical_backfill_slices").collect()}
    want = {(k, *s) for k, t in many.names for s in slices.plan_slices_by_count(lambda a, z: len(many.ids(Window(t, a, z))), date(2023, 1, 1), date(2023, 12, 31), 4)}  # noqa: B023
    assert plan == want and len(plan) > 15
    runs = store.read("enumeration_runs").collect()
    assert {r["status"] for r in runs} == {"complete"} and len(runs) == len(plan)
    ledger = store.read("enumeration_batches").collect()
    assert sum(r["record_count"] for r in ledger) == 55 and all(r["byte_size"] for r in ledger)
    members = {(r["run_id"], r["ordinal"]) for r in store.read("enumeration_membership").collect()}
    assert len(members) == 55 and min(o for _, o in members) == 1
    queries = {r["query"] for r in runs}
    assert Window(runs[0]["journal_title"], runs[0]["start_date"], runs[0]["end_date"]).query() in queries


class Many:
    """Five journals with 3, 7, 11, ... records over a year, one of them with a quoted title."""

    names = tuple((f"k{n}", f'J "{n}"') for n in range(5))

    def ids(self, w):
        n = [t for _, t in self.names].index(w.title)
        days = [date(2023, 1, 1) + timedelta(days=(37 * i * (n + 1)) % 365) for i in range(3 + 4 * n)]
        return [f"{n + 1}{i:03d}" for i, d in enumerate(days) if w.start <= d <= w.end]

    def opened(self, w):
        return len(self.ids(w)), None

    def page(self, w, at, size, handle=None):
        return f"<s>{''.join(article(p, 2023) for p in self.ids(w)[at : at + size])}</s>".encode()


class Odd(Fake):
    """A page of B is no XML; A's window cannot be counted."""

    def opened(self, w):
        if w.title == "Journal A":
            raise OSError("no count")
        return super().opened(w)

    def page(self, w, at, size, handle=None):
        return b"<s>" if at else super().page(w, at, size, handle)


def test_what_fails_is_kept_with_its_journal(spark, tmp_path):
    store = Store(spark, tmp_path / "db")
    with pytest.raises(backfill.IncompleteRun, match="a, b"):
        backfill.run_backfill(store, Odd(), REGISTRY, date(2023, 1, 1), date(2024, 12, 31), tmp_path / "raw", "rev", size=1)
    errors = {r["journal_key"]: r["error"] for r in store.read("historical_backfill_journals").collect()}
    assert "no count" in errors["a"] and "no XML" in errors["b"]
    run = store.read("enumeration_runs").first()
    assert (run["status"], run["expected_count"], run["fetched_count"]) == ("failed", 2, 1)
    assert store.read("enumeration_batches").count() == 2 and len(list((tmp_path / "raw").rglob("batch_*.xml"))) == 2  # pages stay
    assert store.read("historical_backfills").first()["status"] == "failed"


def test_a_day_over_the_limit_fails_its_journal_alone(spark, tmp_path):
    store = Store(spark, tmp_path / "db")
    with pytest.raises(backfill.IncompleteRun, match="journals b"):
        backfill.run_backfill(store, Fake(), REGISTRY, date(2023, 1, 1), date(2024, 12, 31), tmp_path / "raw", "rev", most=1)
    states = {r["journal_key"]: (r["status"], r["error"]) for r in store.read("historical_backfill_journals").collect()}
    assert states["a"] == ("complete", None) and "2 rows on 2023-06-01, more than 1" in states["b"][1]


def test_pages_of_a_task_that_runs_again_are_not_mixed(spark, tmp_path):
    """A second attempt gets other bytes: each ledger names the files of one attempt, and neither overwrites the other's."""
    pages = lambda body: spark.createDataFrame([("r", 0, bytearray(body), None), ("r", 200, None, "down")], "run_id string, retstart bigint, content binary, error string")
    one = files.write_pages(pages(b"<a/>"), tmp_path / "raw").collect()
    two = files.write_pages(pages(b"<b/>"), tmp_path / "raw").collect()
    again = files.write_pages(pages(b"<a/>"), tmp_path / "raw").collect()
    assert one == again and one[0]["path"] != two[0]["path"] and one[1]["path"] is None and one[1]["error"] == "down"
    assert sorted(p.read_bytes() for p in (tmp_path / "raw").rglob("*.xml")) == [b"<a/>", b"<b/>"] and not list((tmp_path / "raw").rglob("*.partial"))
    ledger = spark.createDataFrame(one[:1], "run_id string, retstart bigint, path string, byte_size bigint, sha256 string, error string")
    assert bytes(files.read_written(ledger).first()["content"]) == b"<a/>"
    next((tmp_path / "raw").rglob(one[0]["path"].rsplit("/", 1)[1])).write_bytes(b"<c/>")
    with pytest.raises(Exception, match="changed since it was written"):
        files.read_written(ledger).collect()
    with pytest.raises(ValueError):
        files.write_pages(pages(b"<a/>"), files.CODE / "raw")
