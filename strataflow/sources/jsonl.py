"""Strict JSON lines with line numbers (SRC-09, SRC-10, FN-26)."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from strataflow.functions.record_rules import broken_rule
from strataflow.functions.vocabularies import PROVENANCE_FIELDS, SEMANTIC_FIELDS
from strataflow.operators.scratch import stored
from strataflow.schemas import SEMANTIC

PARSED = f"path string, line bigint, error string, {SEMANTIC}, model string, prompt_version string, screened_at string"

#: Splits up to which their numbers are broadcast.
MOST_BROADCAST = 50_000


def record_error(record: object, provenance: bool = True) -> str | None:
    """The first rule that a decoded record breaks; types are checked as JSON has them, so that true is no number."""
    wanted = (*SEMANTIC_FIELDS, *PROVENANCE_FIELDS) if provenance else SEMANTIC_FIELDS
    if not isinstance(record, dict):
        return "a record must be an object"
    if set(record) != set(wanted):
        return f"Invalid fields; missing={sorted(set(wanted) - set(record))}, extra={sorted(set(record) - set(wanted))}"
    return broken_rule(record, provenance)


def decode_line(line: str, number: int, path: str, provenance: bool) -> dict:
    """A line's number, and its record or its error; a repeated key's last value counts."""
    row: dict = {"path": path, "line": number, "error": None}
    try:
        record = json.loads(line)
        row["error"] = record_error(record, provenance)
        if row["error"] is None:
            row |= record
            row["confidence"] = float(row["confidence"])
    except ValueError as exc:
        row["error"] = f"no JSON: {exc}"
    return row


def decode(lines: list[str], path: str, provenance: bool, skip_blank: bool) -> list[dict]:
    """A row per line, numbered from 1."""
    return [decode_line(line, n, path, provenance) for n, line in enumerate(lines, 1) if not skip_blank or line.strip()]


_KINDS = {"line": pa.int64(), "data_modalities": pa.list_(pa.string()), "computational_centrality": pa.int32(), "confidence": pa.float64()}
_LAYOUT = pa.schema([(n := f.split(" ")[0], _KINDS.get(n, pa.string())) for f in PARSED.split(", ")])


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``line`` (from 1, blank ones counted) and ``value`` (bytes) of the lines of files, however Spark splits these.

    A line ends at a line feed. Lines are counted per split, and the counts of the splits before it are what a
    split's numbers begin behind: two scans, no shuffle of lines, and a file is read by as many tasks as it has splits.
    """
    at = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split")]
    text = spark.read.option("lineSep", "\n").text(path)
    sizes = text.select(*at).groupBy("path", "split").agg(F.count("*").alias("lines"))
    before = F.coalesce(F.sum("lines").over(Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = stored(sizes.select("path", "split", before.alias("before")), "splits")
    few = offsets.count() <= MOST_BROADCAST
    schema = "path string, split bigint, place bigint, value binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, int] = {}
        for batch in batches:
            places = []
            for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[key] = seen.get(key, 0) + 1
                places.append(seen[key])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(places, pa.int64()), batch.column(2)], names=["path", "split", "place", "value"])

    lines = text.select(*at, F.col("value").cast("binary").alias("value")).mapInArrow(run, schema)
    return lines.join(F.broadcast(offsets) if few else offsets, ["path", "split"]).select("path", (F.col("before") + F.col("place")).alias("line"), "value")


def read_records(spark: SparkSession, path: str, provenance: bool = True, skip_blank: bool = True) -> DataFrame:
    """Lines of JSONL files with their errors.

    With ``skip_blank`` a line ends at a line feed (import files, which may be of any size: see ``numbered_lines``); without, at
    every line break that Unicode knows, and blank lines count (raw outputs, which a task reads whole). A line
    that is no UTF-8 is an error of its own.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for where, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_pylist(decode(raw.decode("utf-8").splitlines(), where, provenance, False), _LAYOUT)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for where, number, raw in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                try:
                    line = raw.decode("utf-8")
                except UnicodeDecodeError as exc:
                    rows.append({"path": where, "line": number, "error": f"no UTF-8: {exc}"})
                    continue
                if line.strip():
                    rows.append(decode_line(line, number, where, provenance))
            yield pa.RecordBatch.from_pylist(rows, _LAYOUT)

    if skip_blank:
        return numbered_lines(spark, path).mapInArrow(each, PARSED)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(whole, PARSED)
