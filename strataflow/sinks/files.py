"""Files outside the code, published at once (SNK-01..08, FN-11, FN-25)."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

CODE = Path(__file__).resolve().parents[2]


def outside_code(path: str | Path) -> Path:
    """The resolved path; one inside the code's own folder is refused."""
    out = Path(path).resolve()
    if out.is_relative_to(CODE):
        raise ValueError(f"data may not be written into the code's folder: {out}")
    return out


def publish(path: str | Path, content: bytes | str) -> Path:
    """Write beside the target, then rename: readers see all or nothing."""
    out = outside_code(path)
    out.parent.mkdir(parents=True, exist_ok=True)
    partial = out.with_name(out.name + ".partial")
    partial.write_bytes(content.encode() if isinstance(content, str) else content)
    partial.replace(out)
    return out


def json_line(value: dict) -> str:
    """Sorted keys, spaces behind signs, nulls written, nothing escaped that need not be."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True)


def json_text(value: object) -> str:
    """Compact, sorted keys."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def export_lines(df: DataFrame, path: str | Path, order: Iterable) -> int:
    """An ordered single JSONL file of a queue or sample; rows stream through the driver one partition at a time."""
    out = outside_code(path)
    out.parent.mkdir(parents=True, exist_ok=True)
    partial, n = out.with_name(out.name + ".partial"), 0
    with partial.open("w", encoding="utf-8") as f:
        for row in df.orderBy(*order).toLocalIterator(prefetchPartitions=True):
            f.write(json_line(row.asDict(recursive=True)) + "\n")
            n += 1
    partial.replace(out)
    return n


def folder_uri(path: str | Path) -> str:
    """A folder as all executors name it; a local one outside the code."""
    return str(path).rstrip("/") if "://" in str(path) else outside_code(path).as_uri()


def write_pages(pages: DataFrame, folder: str | Path, flaw: Callable[[bytes], str | None] = lambda content: None) -> DataFrame:
    """Executors write the ``content`` of pages (run_id, retstart, error and others) to files and give its place in return.

    ``path``, ``byte_size`` and ``sha256`` replace ``content``; pages with an ``error`` stay without, and a page that has a
    ``flaw`` is written and gets it as its error. A file's name has the digest of what is in it, and it appears by a rename:
    a task that runs again, or twice at once, leaves files that no row names if it got other pages, and the same
    ones otherwise. Which files count is said by the rows alone, which the caller has to store: Spark commits those of
    one attempt of each task. Any file system that Arrow knows will do.
    """
    root = folder_uri(folder)
    rest = [f for f in pages.schema if f.name not in ("content", "error")]
    schema = StructType([*rest, StructField("path", StringType()), StructField("byte_size", LongType()), StructField("sha256", StringType()), StructField("error", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            made = []
            for run_id, at, content, error in zip(*(batch.column(c).to_pylist() for c in ("run_id", "retstart", "content", "error")), strict=True):
                if content is None:
                    made.append((None, None, None, error))
                    continue
                digest = hashlib.sha256(content).hexdigest()
                name = f"{run_id}/batch_{at:08d}-{digest[:16]}.xml"
                if system.get_file_info(f"{base}/{name}").type == fs.FileType.NotFound:
                    system.create_dir(f"{base}/{run_id}", recursive=True)
                    partial = f"{base}/{run_id}/{uuid.uuid4().hex}.partial"
                    with system.open_output_stream(partial) as out:
                        out.write(content)
                    system.move(partial, f"{base}/{name}")
                made.append((f"{root}/{name}", len(content), digest, error or flaw(content)))
            columns = [pa.array([m[k] for m in made], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), *columns], names=schema.names)

    return pages.mapInArrow(run, schema)


def read_written(ledger: DataFrame) -> DataFrame:
    """The ledger's rows with the ``content`` of their files; a file that is gone, or is not what was written, raises."""
    names = [c for c in ledger.columns if c not in ("path", "byte_size", "sha256")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (path, digest) in enumerate(zip(batch.column("path").to_pylist(), batch.column("sha256").to_pylist(), strict=True)):
                system, at = fs.FileSystem.from_uri(path)
                with system.open_input_stream(at) as f:
                    content = f.read()
                if hashlib.sha256(content).hexdigest() != digest:
                    raise ValueError(f"{path} has changed since it was written")
                yield pa.RecordBatch.from_arrays([*(batch.column(n).slice(i, 1) for n in names), pa.array([content], pa.binary())], names=[*names, "content"])

    return ledger.mapInArrow(run, StructType([*(ledger.schema[n] for n in names), StructField("content", BinaryType())]))


def file_digests(ledger: DataFrame, path_col: str) -> DataFrame:
    """The ledger with ``found_sha256`` of the file that each row names, null if there is none; executors read the files."""

    names = [*ledger.columns, "found_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(path_col).to_pylist():
                digest = None
                if path:
                    system, at = fs.FileSystem.from_uri(path)
                    if system.get_file_info(at).type == fs.FileType.File:
                        with system.open_input_stream(at) as f:
                            sha = hashlib.sha256()
                            while block := f.read(1 << 20):
                                sha.update(block)
                        digest = sha.hexdigest()
                found.append(digest)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=names)

    return ledger.mapInArrow(run, StructType([*ledger.schema, StructField("found_sha256", StringType())]))


def export_report(report: dict, path: str | Path) -> Path:
    return publish(path, json.dumps(report, ensure_ascii=False, indent=2, sort_keys=True, default=str) + "\n")
