"""Bibliographic XML files to typed records (SRC-08)."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.functions.scalars import first_date, normalize_doi
from strataflow.schemas import AUTHOR, RECORD

_DATE = "struct<year:string,month:string,day:string,medline:string>"
_RAW = f"pmid string, raw_doi string, source_journal_title string, dates array<{_DATE}>, title string, abstract string, article_types array<string>, authors array<{AUTHOR}>, mesh_terms array<string>"
#: Records that are handed on together, or those of one document if they are more.
FRAME_ROWS = 2000
#: Where the four dates of a record are, in the order in which they are tried.
_DATES = (".//Article/ArticleDate", ".//JournalIssue/PubDate", ".//PubmedData/History/PubMedPubDate[@PubStatus='pubmed']", ".//PubmedData/History/PubMedPubDate[@PubStatus='entrez']")


def _said(node: ET.Element | None) -> str:
    """All text under a node, inline markup included, white space collapsed."""
    return re.sub(r"\s+", " ", "".join(node.itertext())).strip() if node is not None else ""


def _author(node: ET.Element) -> dict | None:
    together = _said(node.find("CollectiveName"))
    if together:
        return {"collective": together}
    out = {field: _said(node.find(tag)) for field, tag in (("last", "LastName"), ("fore", "ForeName"), ("initials", "Initials"))}
    marks = [_said(i) for i in node.iter("Identifier") if i.get("Source", "").casefold() == "orcid"]
    if marks:
        out["orcid"] = marks[-1]
    return out if any(out.values()) else None


def _record(item: ET.Element) -> dict | None:
    pmid = _said(item.find(".//MedlineCitation/PMID"))
    if not pmid:
        return None
    parts = [((n.get("Label") or "").strip(), _said(n)) for n in item.iterfind(".//Article/Abstract/AbstractText")]
    doi = next((n for n in item.iterfind(".//PubmedData/ArticleIdList/ArticleId") if n.get("IdType") == "doi"), None)
    dates = [item.find(p) for p in _DATES]
    listed = lambda path, sub="": [t for n in item.iterfind(path) if (t := _said(n.find(sub) if sub else n))]
    return {
        "pmid": pmid,
        "raw_doi": None if doi is None else _said(doi),
        "source_journal_title": _said(item.find(".//Journal/Title")) or _said(item.find(".//MedlineJournalInfo/MedlineTA")) or "Unknown",
        "dates": [None if d is None else {k: _said(d.find(t)) for k, t in (("year", "Year"), ("month", "Month"), ("day", "Day"), ("medline", "MedlineDate"))} for d in dates],
        "title": _said(item.find(".//Article/ArticleTitle")),
        "abstract": "\n".join(f"{label}: {text}" if label else text for label, text in parts if text),
        "article_types": list(dict.fromkeys(listed(".//Article/PublicationTypeList/PublicationType"))),
        "authors": [a for n in item.iterfind(".//Article/AuthorList/Author") if (a := _author(n))],
        "mesh_terms": list(dict.fromkeys(listed(".//MeshHeadingList/MeshHeading", "DescriptorName"))),
    }


def parse_records(files: DataFrame, content: str = "content", batch: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Records of XML documents in a binary column; those without an id are left out.

    With ``batch``, a column of numbers, each record has its document's as ``batch`` and its own in the
    document, from 1, as ``place``. Columns named in ``carry`` go with every record of their document.

    The tree is read in Python, since Spark's XML functions lose text around inline markup; identifiers
    and dates are normalised by column functions behind it. A document that is no XML fails the job.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["pmid", "raw_doi", "source_journal_title", "dates", "title", "abstract", "article_types", "authors", "mesh_terms", *(["batch", "place"] if batch else []), *carry]
        made: list[dict] = []
        for pdf in frames:
            for raw, number, *own in zip(pdf[content], pdf[batch] if batch else pdf[content], *(pdf[c] for c in carry), strict=True):
                rows = [r for item in ET.fromstring(bytes(raw)).iterfind(".//PubmedArticle") if (r := _record(item))]
                for place, r in enumerate(rows, 1):
                    r |= {"batch": number, "place": place, **dict(zip(carry, own, strict=True))}
                    r["authors"] = [{k: a.get(k) for k in ("last", "fore", "initials", "orcid", "collective")} for a in r["authors"]]
                made += rows
                if len(made) >= FRAME_ROWS:  # small documents share a frame
                    yield pd.DataFrame(made, columns=names)
                    made = []
        if made:
            yield pd.DataFrame(made, columns=names)

    kinds = "".join(f", `{c}` {files.schema[c].dataType.simpleString()}" for c in carry)
    rows = files.select(content, *([batch] if batch else []), *carry).mapInPandas(run, _RAW + (", batch bigint, place bigint" if batch else "") + kinds)
    dated = rows.withColumn("d", first_date("dates"))  # each date's expressions stand in the plan once
    fields = {"doi": normalize_doi(F.col("raw_doi")), "publication_date": F.col("d.value"), "publication_date_precision": F.col("d.precision"), "publication_year": F.col("d.year")}
    return dated.select(*[fields[c].alias(c) if c in fields else F.col(c) for c in [f.split(" ")[0] for f in _fields(RECORD)]], *(["batch", "place"] if batch else []), *carry)


def flaw_of(content: bytes) -> str | None:
    """What keeps a document from being parsed."""
    try:
        ET.fromstring(content)
    except ET.ParseError as exc:
        return f"no XML: {exc}"
    return None


def _fields(ddl: str) -> list[str]:
    """Top-level fields of a DDL string."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(ddl):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(ddl[at:i].strip())
            at = i + 1
    return [*out, ddl[at:].strip()]


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Raw batch files with size and digest: the ledger (FN-10), and what ``parse_records`` takes."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "content", F.col("length").alias("byte_size"), F.sha2("content", 256).alias("sha256"))
