from datetime import date, datetime, timedelta

import pytest

from strataflow.operators import slices
from strataflow.plans import carriers


def put(spark, root, name, data, ddl):
    spark.createDataFrame(data, ddl).write.parquet(f"{root}/{name}.parquet")


def test_review_queue_holds_every_document(spark, tmp_path):
    docs = [(i, "en", i * 7 % 90) for i in range(1203)]
    marks = [(i, i % 2) for i in range(0, 1203, 3)]
    put(spark, tmp_path, "documents", docs, "doc_id long, lang string, n_chars long")
    put(spark, tmp_path, "labels", marks, "doc_id long, quality int")
    good = dict(marks)
    want = sorted(docs, key=lambda d: (-good.get(d[0], 0), -d[2], -d[0]))
    got = carriers.review_queue(spark, str(tmp_path)).orderBy("position").collect()
    assert [tuple(r) for r in got] == [(d[0], "en", good.get(d[0], 0) == 1, n) for n, d in enumerate(want, 1)]


def test_slices_keep_a_fixed_limit(spark, tmp_path):
    first = date(1995, 1, 1)
    orders = [(n, "1-URGENT", datetime(1995, 1, 1) + timedelta(days=n % 2400)) for n in range(9000)]
    put(spark, tmp_path / "a", "orders", orders, "o_orderkey long, o_orderpriority string, o_orderdate timestamp_ntz")
    plan = sorted(tuple(r) for r in carriers.date_slices(spark, str(tmp_path / "a")).collect())
    days = [o[2].date() for o in orders]
    want = slices.plan_slices_by_count(lambda a, z: sum(a <= d <= z for d in days), first, date(2001, 12, 31), 1000)
    assert plan == [("1-URGENT", str(a), str(z), n) for a, z, n in want] and max(p[3] for p in plan) <= 1000
    held = carriers.slice_membership(spark, str(tmp_path / "a")).collect()
    assert sum(r["members"] for r in held) == 9000 and all(r["members"] == r["planned_count"] <= 1000 for r in held)
    put(spark, tmp_path / "b", "orders", [(n, "1-URGENT", datetime(1995, 1, 1)) for n in range(1001)], "o_orderkey long, o_orderpriority string, o_orderdate timestamp_ntz")
    with pytest.raises(Exception, match="SliceTooLarge"):
        carriers.date_slices(spark, str(tmp_path / "b")).collect()


def test_partial_dates_cover_all_years(spark, tmp_path):
    days = [date(1995, 1, 1) + timedelta(days=3 * n) for n in range(800)]
    put(spark, tmp_path, "orders", [(n, datetime(d.year, d.month, d.day)) for n, d in enumerate(days)], "o_orderkey long, o_orderdate timestamp_ntz")
    got = {r["o_orderkey"]: r for r in carriers.partial_dates(spark, str(tmp_path)).collect()}
    start = date(1996, 1, 1)
    assert len(got) == 800 and min(r["year"] for r in got.values()) == 1995
    for n, d in enumerate(days):
        text = [f"{d.year:04d}", f"{d:%Y-%m}", f"{d:%Y-%m-%d}", f"{d.year:04d}"][n % 4]
        assert (got[n]["value"], got[n]["precision"], got[n]["year"]) == (text, ["year", "month", "day", "year"][n % 4], d.year)
        assert got[n]["middle"] == str(start + timedelta(days=(d - start).days // 2))
        assert got[n]["period_start"] == str(max(date(d.year, 1, 1), date(1996, 3, 1))) and got[n]["period_end"] == str(min(date(d.year, 12, 31), date(1999, 6, 30)))


def test_registry_check_counts_every_customer(spark, tmp_path):
    put(spark, tmp_path, "nation", [(0, "A"), (1, "B"), (2, "C")], "n_nationkey int, n_name string")
    put(spark, tmp_path, "customer", [(1, 0, 9500.0), (2, 0, -10.0), (3, 1, 9000.0)], "c_custkey long, c_nationkey int, c_acctbal double")
    got = sorted(tuple(r) for r in carriers.registry_check(spark, str(tmp_path)).collect())
    assert got == [(0, "A", 2, True), (1, "B", 1, True), (2, "C", 0, False)]
