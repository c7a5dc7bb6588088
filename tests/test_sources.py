import json
import urllib.error
from datetime import date

import pytest

from strataflow.sinks import files
from strataflow.sources import config, jsonl
from strataflow.sources.paged import Remote, Window
from strataflow.sources.xml_records import parse_records

XML = """<?xml version="1.0"?><!DOCTYPE PubmedArticleSet SYSTEM "x.dtd"><PubmedArticleSet>
<PubmedArticle><MedlineCitation><PMID>40000001</PMID><Article><Journal><Title>Synthetic  Journal</Title><JournalIssue><PubDate><Year>2025</Year></PubDate></JournalIssue></Journal>
<ArticleTitle>Syn <i>tum</i> x.</ArticleTitle><Abstract><AbstractText Label="BACKGROUND">One<sub>2</sub></AbstractText><AbstractText>Two</AbstractText><AbstractText/></Abstract>
<AuthorList><Author><LastName>A</LastName><ForeName>B</ForeName><Initials>C</Initials><Identifier Source="ORCID">0000</Identifier></Author><Author><CollectiveName>Group</CollectiveName></Author><Author/></AuthorList>
<PublicationTypeList><PublicationType>Journal Article</PublicationType><PublicationType>Journal Article</PublicationType></PublicationTypeList>
<ArticleDate><Year>2026</Year><Month>Aug</Month><Day>14</Day></ArticleDate></Article>
<MeshHeadingList><MeshHeading><DescriptorName>Neoplasms</DescriptorName></MeshHeading><MeshHeading><DescriptorName>Neoplasms</DescriptorName></MeshHeading></MeshHeadingList></MedlineCitation>
<PubmedData><ArticleIdList><ArticleId IdType="doi">10.1000/SYN.001</ArticleId></ArticleIdList></PubmedData></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>40000002</PMID><Article><Journal><JournalIssue><PubDate><MedlineDate>2025 Winter</MedlineDate></PubDate></JournalIssue></Journal><ArticleTitle>R</ArticleTitle></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID> </PMID></MedlineCitation></PubmedArticle></PubmedArticleSet>"""


def test_xml(spark):
    df = parse_records(spark.createDataFrame([(bytearray(XML.encode()),)], "content binary"))
    a, b = sorted(df.collect(), key=lambda r: r["pmid"])
    assert (a["doi"], a["publication_date"], a["publication_date_precision"], a["publication_year"]) == ("10.1000/syn.001", "2026-08-14", "day", 2026)
    assert (a["title"], a["abstract"], a["source_journal_title"]) == ("Syn tum x.", "BACKGROUND: One2\nTwo", "Synthetic Journal")
    assert (a["article_types"], a["mesh_terms"]) == (["Journal Article"], ["Neoplasms"])
    assert [x.asDict() for x in a["authors"]] == [{"last": "A", "fore": "B", "initials": "C", "orcid": "0000", "collective": None}, {"last": None, "fore": None, "initials": None, "orcid": None, "collective": "Group"}]
    assert (b["doi"], b["publication_date"], b["publication_date_precision"], b["source_journal_title"]) == (None, "2025", "year", "Unknown")


RECORD = {"pmid": "1", "disease": "cancer", "study": "review", "primary_contribution": "other", "data_modalities": ["scRNA"], "computational_centrality": 2, "new_experimental_data": "none", "public_data_reuse": "minor", "relevance": "YES", "confidence": 1, "rationale": "why"}


@pytest.mark.parametrize(
    ("change", "message"),
    [({"confidence": 2}, "confidence"), ({"confidence": True}, "confidence"), ({"computational_centrality": 3.0}, "centrality"), ({"model": "m"}, "extra=['model']"), ({"relevance": "PROBABLY"}, "Invalid relevance"), ({"pmid": "²"}, "digits"), ({"data_modalities": []}, "non-empty")],
)
def test_record_errors(change, message):
    assert message in jsonl.record_error(RECORD | change, provenance=False)


def test_jsonl_files(spark, tmp_path):
    good = json.dumps(RECORD)
    (tmp_path / "x.jsonl").write_text(f"{good}\n\nHere: {good}\n```\n")
    got = jsonl.read_records(spark, str(tmp_path / "x.jsonl"), provenance=False).orderBy("line").collect()
    assert [(r["line"], r["error"] is None) for r in got] == [(1, True), (3, False), (4, False)] and got[0]["confidence"] == 1.0
    assert jsonl.read_records(spark, str(tmp_path / "x.jsonl"), provenance=False, skip_blank=False).count() == 4


def test_a_file_of_lines_is_read_by_several_tasks(spark, tmp_path):
    """Numbers and errors are those of the file read from its beginning, wherever it is split."""
    good = json.dumps(RECORD | {"rationale": "größer \u2028 \x0b " + "x" * 70}, ensure_ascii=False)
    texts = {
        "a.jsonl": "".join(f"{good}\n" if i % 3 else "\n  \n" if i % 2 else "{broken\r\n" for i in range(200)),
        "b.jsonl": f"\n\n{good}", "c.jsonl": "", "d.jsonl": "\n", "e.jsonl": f"[]\n{good}\n\n\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text, newline="")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "701")
    try:
        lines = jsonl.numbered_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 20
        rows = jsonl.read_records(spark, str(tmp_path), provenance=False).collect()
        numbered = lines.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    got = sorted((r["path"].rsplit("/", 1)[1], r["line"], r["error"], r["pmid"]) for r in rows)
    want = sorted((name, d["line"], d["error"], d.get("pmid")) for name, text in texts.items() for d in jsonl.decode(text.split("\n"), "", False, True))
    assert [(*x[:2], x[2] or "", x[3] or "") for x in got] == [(*x[:2], x[2] or "", x[3] or "") for x in want] and len(got) > 150
    every = {(name, n): line for name, text in texts.items() for n, line in enumerate(text.split("\n"), 1) if n <= text.count("\n") or line}
    assert {(r["path"].rsplit("/", 1)[1], r["line"]): bytes(r["value"]).decode() for r in numbered} == every


def test_a_line_that_is_no_utf8_is_its_own_error(spark, tmp_path):
    (tmp_path / "x.jsonl").write_bytes(json.dumps(RECORD).encode() + b"\n\xff\xfe\n" + json.dumps(RECORD).encode())
    got = jsonl.read_records(spark, str(tmp_path / "x.jsonl"), provenance=False).orderBy("line").collect()
    assert [(r["line"], (r["error"] or "")[:8]) for r in got] == [(1, ""), (2, "no UTF-8"), (3, "")]


def test_dates_are_bound_once_and_the_plan_compiles(spark, caplog):
    """No date's expressions are repeated for each field that is taken from them."""
    df = parse_records(spark.createDataFrame([(bytearray(XML.encode()),)], "content binary"))
    said = df._jdf.queryExecution().debug().codegenToSeq()
    sizes = [said.apply(i)._3().maxMethodCodeSize() for i in range(said.size())]
    assert sizes and max(sizes) < 8000, sizes  # beyond, the JVM does not compile a method


def test_registry(spark, tmp_path):
    entry = lambda k, t, p: {"key": k, "title": t, "pubmed_title": t, "tier": "Gold", "tracks": [], "priority": p}
    path = tmp_path / "r.json"
    path.write_text(json.dumps({"version": "v1", "journals": [entry("a", "A", 1), entry("b", "B", 2)]}))
    r = config.load_registry(path)
    assert r.by_key("b").title == "B" and r.frame(spark).count() == 2
    with pytest.raises(ValueError, match="a, b"):
        r.by_key("c")
    for rows in ([entry("a", "A", 1), entry("b", "a", 2)], [entry("a", "A", 2), entry("b", "B", 1)]):
        path.write_text(json.dumps({"version": "v1", "journals": rows}))
        with pytest.raises(ValueError):
            config.load_registry(path)
    path.write_text("[]")
    with pytest.raises(ValueError):
        config.read_object(path)
    banned = spark.createDataFrame([("b",)], "title string")
    assert [x["key"] for x in config.without_blacklisted(r.frame(spark), banned).collect()] == ["a"]


def test_remote_counts_pages_and_retries():
    calls, slept = [], []

    def send(url, body, timeout):
        calls.append(body.decode())
        if len(calls) == 1:
            raise urllib.error.HTTPError(url, 503, "busy", {}, None)
        return json.dumps({"esearchresult": {"count": "5", "querykey": "1", "webenv": "w"}}).encode() if "esearch" in url else b"<x/>"

    source = Remote("a@b.c", send=send, sleep=slept.append)
    window = Window("Cell", date(2023, 1, 1), date(2023, 12, 31))
    assert [at for at, _ in source.pages(window, 2)] == [0, 2, 4]
    assert 1 in slept and "retstart=4" in calls[-1]
    with pytest.raises(ValueError):
        Remote("nobody")
    with pytest.raises(ValueError):
        list(source.pages(window, 0))


def test_sinks(spark, tmp_path):
    with pytest.raises(ValueError):
        files.outside_code(files.CODE / "x.json")
    df = spark.createDataFrame([(2, "ü", None), (1, "a", "x")], "n int, t string, o string")
    assert files.export_lines(df, tmp_path / "q.jsonl", ["n"]) == 2
    assert (tmp_path / "q.jsonl").read_text().splitlines()[1] == '{"n": 2, "o": null, "t": "ü"}'
