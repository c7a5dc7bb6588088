"""Checks of packets against the store, imports, sources, samples and sinks beyond those of single functions."""

import json
import time
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from strataflow.functions import scalars
from strataflow.functions.record_rules import broken_rule, column_rules
from strataflow.operators import batches, coverage, sample, slices, stats
from strataflow.plans import packets
from strataflow.plans.store import ConcurrentChange, Store
from strataflow.schemas import TABLES
from strataflow.sources import introspect, paged_source
from strataflow.sources.paged import Remote, Snapshot, Window
from strataflow.sources.xml_records import _fields

RECORD = {"pmid": "1", "disease": "cancer", "study": "review", "primary_contribution": "other", "data_modalities": ["scRNA"], "computational_centrality": 2, "new_experimental_data": "none", "public_data_reuse": "minor", "relevance": "NO", "confidence": 0.5, "rationale": "why", "model": "m", "prompt_version": "v1", "screened_at": "2026-09-01T00:00:00Z"}
QUOTAS = {"candidate_priority": 6, "non_priority_original_or_unclear": 4, "obvious_non_original": 2}


@pytest.fixture
def store(spark, tmp_path):
    out = Store(spark, tmp_path / "db")
    names = [f.split(" ")[0] for f in _fields(TABLES["articles"])]
    out.append("articles", [dict.fromkeys(names) | {"pmid": str(70 + i), "title": "T", "article_types": ["Journal Article"], "mesh_terms": []} for i in range(14)])
    return out


def sampled(store):
    strata = [k for k, n in QUOTAS.items() for _ in range(n)]
    store.append("calibration_samples", [("c1", "s", "v1", "2026")])
    store.append("calibration_sample_items", [("c1", str(70 + i), k, 9, f"{i:02d}", "2026") for i, k in enumerate(strata)])
    order = sorted((k, f"{i:02d}", str(70 + i)) for i, k in enumerate(strata))
    return [p for *_, p in order], [k for k, *_ in order]


def test_a_packet_has_to_be_a_part_of_the_stored_sample(store):
    ids, strata = sampled(store)
    good = {"calibration_id": "c1", "prompt_version": "v1", "ordered_pmids": ids[4:8], "sampling_strata": strata[4:8]}
    packets.check_packet(store, good, QUOTAS)
    bad = [
        ({"calibration_id": "c2"}, "unknown"), ({"prompt_version": "v2"}, "prompt version"), ({"ordered_pmids": ids[4:7] + ["1"]}, "lacks"), ({"ordered_pmids": ids[4:7] + ids[8:9]}, "contiguous"),
        ({"ordered_pmids": ids[4:8][::-1]}, "contiguous"), ({"sampling_strata": strata[:3] + ["other"]}, "strata"), ({"ordered_pmids": [], "sampling_strata": []}, "1 to 50"), ({"ordered_pmids": ids[4:5] * 4}, "each once"),
    ]
    for change, message in bad:
        with pytest.raises(packets.InvalidPacket, match=message):
            packets.check_packet(store, good | change)
    with pytest.raises(packets.InvalidPacket, match="locked"):
        packets.check_packet(store, good, QUOTAS | {"candidate_priority": 7})


def test_a_manifest_without_a_key_is_refused(store, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"batch_id": "x"}))
    with pytest.raises(packets.InvalidPacket, match="lacks"):
        packets.validate_answer(store, tmp_path / "m.json", tmp_path / "o", "m", "o", True, "2026-09-01T00:00:00Z")


def test_files_are_imported_whole_or_not_at_all(store, tmp_path):
    line = lambda **more: json.dumps(RECORD | more)
    path = tmp_path / "in.jsonl"
    path.write_text("\n".join([line(pmid="70"), "", line(pmid="71"), line(pmid="70", rationale="again")]) + "\n")
    assert packets.import_file(store, path) == (3, 2) and packets.import_file(store, path) == (3, 0)
    rows = {r["pmid"]: r for r in store.read("llm_screens").collect()}
    assert rows["70"]["rationale"] == "why" and {r["id"] for r in rows.values()} == {1, 2}
    path.write_text("\n".join([line(pmid="72"), line(confidence=7)]))
    with pytest.raises(packets.InvalidPacket, match="line 2: confidence"):
        packets.import_file(store, path)
    path.write_text("\n".join([line(pmid="72"), line(pmid="9999")]))
    with pytest.raises(packets.InvalidPacket, match="unknown articles: 9999"):
        packets.import_file(store, path)
    assert store.read("llm_screens").count() == 2


def test_provenance_is_checked_behind_the_answer():
    text = json.dumps({k: v for k, v in RECORD.items() if k not in ("model", "prompt_version", "screened_at")})
    assert packets.check_answer(text, ["1"], "m", "v1", "2026-09-01T00:00:00Z")[1] is None
    assert "provenance" in packets.check_answer(text, ["1"], "m", "v1", "some day")[1]


def test_prompts(store):
    assert packets.packet_prompt("a {input} b", None, "x") == "a x b"
    assert packets.packet_prompt("Return the model.", "{}", "x", {"Return the model.": "No provenance."}) == "No provenance.\n\nJSON SCHEMA OF A LINE\n{}\n\nINPUT JSONL\nx"
    with pytest.raises(packets.InvalidPacket, match="lacks"):
        packets.packet_prompt("a", None, "x", {"b": "c"})


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path):
    one, two = Store(spark, tmp_path / "db"), Store(spark, tmp_path / "db")
    with pytest.raises(ConcurrentChange), one.transaction():
        one.append("schema_meta", [("a", "1")])
        two.append("schema_meta", [("b", "2")])
    assert sorted(r["key"] for r in one.read("schema_meta").collect()) == ["b", "schema_version"]


CHANGES = [{}, {"relevance": "PERHAPS"}, {"data_modalities": []}, {"data_modalities": ["scRNA", "scRNA"]}, {"data_modalities": ["x"]}, {"computational_centrality": 4}, {"confidence": -0.1}, {"rationale": " "}, {"pmid": "1x"}, {"screened_at": "now"}, {"screened_at": "2026-13-01"}]


def test_one_rule_table_drives_both_checks(spark):
    kinds = {"data_modalities": "array<string>", "computational_centrality": "int", "confidence": "double"}
    df = spark.createDataFrame([tuple((RECORD | c).values()) for c in CHANGES], ", ".join(f"{k} {kinds.get(k, 'string')}" for k in RECORD))
    checks = column_rules()
    found = df.select(*[ok.alias(f"r{i}") for i, (_, ok) in enumerate(checks)]).collect()
    for change, row in zip(CHANGES, found, strict=True):
        columns = next((m for (m, _), ok in zip(checks, row, strict=True) if not ok), None)
        decoded = broken_rule(RECORD | change)
        assert columns == decoded or decoded.startswith(f"{columns}: ")


def test_samples_by_fraction_are_cut_exactly(spark):
    df = spark.range(3000).select((F.col("id") % 2500).alias("k"))
    order = sorted((r["hash_rank"], r["k"]) for r in df.distinct().select("k", scalars.hash_rank("s", F.col("k")).alias("hash_rank")).collect())
    for share in (0.0004, 0.1, 0.5, 1.0):
        for most in (1, 40, 10_000):
            got = sample.fraction_sample(df, "k", share, "s", most)
            n = -int(-2500 * share // 1)
            assert sorted((r["hash_rank"], r["k"]) for r in got.collect()) == order[:n]
    assert sample.fraction_sample(df.limit(0), "k", 0.5, "s").count() == 0
    with pytest.raises(ValueError):
        sample.fraction_sample(df, "k", 0, "s")


def test_a_hot_stratum_is_cut_before_it_is_ranked(spark):
    df = spark.range(0, 30_000, 1, 60).select(F.col("id").alias("k"), F.when(F.col("id") % 10 == 0, "small").otherwise("hot").alias("s"))
    quotas = {"hot": 40, "small": 30, "none": 5}
    order = {s: [] for s in quotas}
    for r in df.select("k", "s", scalars.hash_rank("x", F.col("k")).alias("h")).collect():
        order[r["s"]].append((r["h"], r["k"]))
    got = sample.stratified_sample(df, "k", "s", quotas, "x").collect()
    assert sorted((r["hash_rank"], r["k"]) for r in got) == sorted(x for s, n in quotas.items() for x in sorted(order[s])[:n])
    assert {r["stratum"]: r["population_size"] for r in got} == {"hot": 27_000, "small": 3000}
    frame = df.select("k", F.col("s").alias("stratum"), scalars.hash_rank("x", F.col("k")).alias("hash_rank"))
    sizes = frame.groupBy("stratum").agg(F.count("*").alias("population_size"))
    assert sample._beginnings(frame, sizes, quotas).count() < 400
    same = spark.createDataFrame([(1, "hot")] * 5000 + [(2, "hot")], "k long, s string")  # two keys: no share of the hashes is right
    assert sample.stratified_sample(same, "k", "s", {"hot": 10}, "x").count() == 10


def test_the_human_queue_has_all_three_kinds(spark):
    df = spark.createDataFrame([(i, ("YES", "MAYBE", "NO")[i % 3]) for i in range(90)] + [(99, None)], "k long, d string")
    reasons = {r["reason"]: r["count"] for r in sample.human_queue(df, "k", "d", 0.1, "s").groupBy("reason").count().collect()}
    assert reasons == {"YES": 30, "MAYBE": 30, "NO sample": 3}


def test_corpus_batches_number_everything(spark):
    placed = batches.corpus_batches(spark.range(250).repartition(5), [F.asc("id")], 100, "id").collect()
    assert {(r["id"] // 100, r["id"] % 100 + 1) for r in placed} == {(r["batch_no"], r["ordinal"]) for r in placed} and len(placed) == 250


def test_union_counts_by_year(spark):
    slices = spark.createDataFrame([("r1", "complete"), ("r2", "complete"), ("r3", "failed")], "enumeration_run_id string, status string")
    members = spark.createDataFrame([("r1", "1"), ("r1", "2"), ("r2", "2"), ("r2", "3"), ("r3", "4")], "run_id string, pmid string")
    dated = spark.createDataFrame([("1", 2020), ("2", 2021), ("3", 2021), ("4", 2021)], "pmid string, publication_year int")
    count = lambda **more: coverage.union_count(slices, members, **more).first()["observed_count"]
    assert (count(), count(articles=dated, year=2021), count(articles=dated, year=2020), count(articles=dated, year=1990)) == (3, 2, 1, 0)


def test_records_without_a_stratum_count(spark):
    cells = spark.createDataFrame([("a", 8, 0, 2, 0), (None, 1, 0, 3, 0)], "lang string, tp long, fp long, fn long, tn long")
    sizes = spark.createDataFrame([("a", 100), (None, 300)], "lang string, population_size long")
    want = (10 * 8 + 75 * 1) / (10 * 10 + 75 * 4)
    assert abs(stats.weighted_recall(cells, sizes, "lang").first()[0] - want) < 1e-6
    assert stats.bootstrap_recall(cells, sizes, "lang", 50, 1).first()["replicates"] == 50


def test_case_folding_and_lists(spark):
    words = ["Straße", "ΣΊΣΥΦΟΣ ς", "ﬁne", "İx", "ʼN", "ẞ", "ſ", "ABC", "", None, "Ǆ", "ẞΐ"]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(scalars.casefold(F.col("w"))).collect()]
    assert got == [w if w is None else w.casefold() for w in words]
    lists = [["a", 'b"c'], [], None, ["x"]]
    said = [r[0] for r in spark.createDataFrame([(x,) for x in lists], "x array<string>").select(scalars.spaced_list(F.col("x"))).collect()]
    assert said == [None if x is None else json.dumps(x) for x in lists]


def test_table_layouts(spark):
    info = introspect.table_info(spark.createDataFrame([], "a int, b array<string>")).collect()
    assert [tuple(r) for r in info] == [("a", "int", True, 1), ("b", "array<string>", True, 2)]
    keys = {r["table"]: (r["key"], r["columns"]) for r in introspect.tables(spark).collect()}
    assert set(keys) == set(TABLES) and all(set(k) <= set(c) for k, c in keys.values())


class Client:
    """Pages of a window without a network."""

    def opened(self, window):
        return (window.end - window.start).days + 1, window.title.lower()

    def page(self, window, at, size, handle=None):
        return f"{window.title} {handle} {at}".encode()


def test_pages_are_dealt_to_lanes_of_a_source(spark):
    windows = [Window("A", date(2023, 1, 1), date(2023, 1, 5)), Window("B", date(2023, 1, 1), date(2023, 1, 2))]
    counts = paged_source.read_windows(spark, windows, "count", client="tests.test_more:Client")
    assert sorted((r["title"], r["records"]) for r in counts.collect()) == [("A", 5), ("B", 2)]
    pages = paged_source.read_windows(spark, windows, size=2, lanes=3, client="tests.test_more:Client")
    assert pages.rdd.getNumPartitions() == 3
    want = [("A", 0, b"A a 0"), ("A", 2, b"A a 2"), ("A", 4, b"A a 4"), ("B", 0, b"B b 0")]
    assert sorted((r["title"], r["retstart"], bytes(r["content"])) for r in pages.collect()) == want
    frame = spark.createDataFrame([(w.title, w.start, w.end) for w in windows] + [("C", date(2023, 1, 2), date(2023, 1, 1))], "title string, slice_start date, slice_end date")
    asked = paged_source.page_requests(paged_source.read_counts(frame, Client(), 2).drop("error"), 2)
    got = paged_source.read_pages(asked, Client(), 2, 2)
    assert got.rdd.getNumPartitions() == 2 and sorted((r["title"], r["retstart"], bytes(r["content"])) for r in got.collect()) == want
    with pytest.raises(ValueError):
        paged_source.page_requests(frame, 0)


def logged_send(url, body, timeout):
    """A transport that writes down when it was asked, in the folder that the contact address names."""
    import urllib.parse

    asked = urllib.parse.parse_qs(body.decode())
    with open(asked["email"][0].split("@")[1], "a") as f:
        f.write(f"{time.time()}\n")
    return json.dumps({"esearchresult": {"count": "9", "querykey": "1", "webenv": "w x"}}).encode() if "esearch" in url else f"{asked['retstart'][0]} {asked['WebEnv'][0]}".encode()


def test_lanes_keep_to_the_rate_of_the_source_together(spark, tmp_path):
    source = Remote(f"a@{tmp_path / 'log'}", send=logged_send)
    source.gap = 0.05
    windows = [Window(t, date(2023, 1, 1), date(2023, 1, 5)) for t in "ABCD"]
    frame = spark.createDataFrame([(w.title, w.start, w.end) for w in windows], "title string, slice_start date, slice_end date")
    counted = paged_source.read_counts(frame, source, 4).drop("error").cache()
    got = paged_source.read_pages(paged_source.page_requests(counted, 2), source, 2, 4).collect()
    at = sorted(float(x) for x in (tmp_path / "log").read_text().split())
    assert len(at) == 4 + 4 * 5
    assert all(b - a >= 4 * 0.05 - 0.02 for a, b in zip(at[4:], at[8:], strict=False))  # of five requests the last is four shares behind the first
    want = [(w.title, n, c) for w in windows for n, c in Remote(f"a@{tmp_path / 'other'}", send=logged_send, sleep=lambda s: None).pages(w, 2)]
    assert sorted((r["title"], r["retstart"], bytes(r["content"])) for r in got) == want
    assert not [r for r in got if r["error"]]


def test_windows_are_counted_and_halved_together(spark):
    days = [("x", date(2020, 1, 1) + timedelta(days=i * 7 % 200)) for i in range(300)] + [("y", date(2020, 3, 1))] * 3
    records = spark.createDataFrame([(t, d, str(i)) for i, (t, d) in enumerate(days)], "journal string, day date, pmid string")
    bounds = (date(2020, 1, 1), date(2020, 12, 31))
    windows = spark.createDataFrame([(t, *bounds) for t in "xyz"], "title string, slice_start date, slice_end date")
    asked = []

    def counts(frontier):
        asked.append(frontier.count())
        return Snapshot(records).counts(frontier)

    got = {tuple(r) for r in slices.plan_slices_by_level(windows, counts, 20).select("title", "slice_start", "slice_end", "planned_count").collect()}
    assert got == {(t, *s) for t in "xyz" for s in slices.plan_slices_by_count(lambda a, z: sum(k == t and a <= d <= z for k, d in days), *bounds, 20)}  # noqa: B023
    assert asked[0] == 3 and len(asked) <= 10
    with pytest.raises(slices.SliceTooLarge, match="3 rows on 2020-03-01, more than 2"):
        slices.plan_slices_by_level(windows.filter("title = 'y'"), Snapshot(records).counts, 2)


def test_a_store_writes_what_comes_and_reads_the_latest(spark, tmp_path, monkeypatch):
    from strataflow.operators.upsert import DuplicateKey
    from strataflow.plans import store as module

    for most in (3, 100):
        monkeypatch.setattr(module, "MOST_PARTS", most)
        store = Store(spark, tmp_path / f"db{most}")
        n_range = lambda n: range(n, n + 3)
        want = {}
        for n in range(6):
            batch = [("b", i, 10 * n + i, None, None, None) for i in n_range(n)]
            store.upsert("enumeration_batches", batch)
            want |= {b[1]: b[2] for b in batch}
        store.insert_ignore("enumeration_batches", [("b", 0, 999, None, None, None), ("b", 90, 1, None, None, None)])
        store.append("enumeration_batches", [("b", 91, 2, None, None, None)])
        want |= {90: 1, 91: 2}
        for bad in ([("b", 91, 3, None, None, None)], [("c", 1, 1, None, None, None)] * 2):
            with pytest.raises(DuplicateKey):
                store.append("enumeration_batches", bad)
        assert {r["retstart"]: r["record_count"] for r in store.read("enumeration_batches").collect()} == want
        assert store.read("enumeration_batches").count() == len(want)
