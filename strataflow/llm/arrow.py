"""Arrow plumbing that the Python operators share."""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

#: Rows of a batch handed on at once; bounds a worker's memory whatever Spark's batch size is.
MAX_BATCH_BYTES = 2 << 20


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
_HELD: list[tuple[str, Callable[[], None]]] = []


def exclusive(name: str, drop: Callable[[], None] = lambda: None) -> None:
    """Say that this worker now serves one operator: the tables that another one kept in it are dropped.

    Workers are reused; without this a pipeline's worker would hold the tables of all its stages.
    """
    if _HELD and _HELD[0][0] != name:
        _HELD.pop()[1]()
    if not _HELD:
        _HELD.append((name, drop))


def by_bytes(batch: pa.RecordBatch, most: int = MAX_BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of ``batch`` of about ``most`` bytes; a larger single row stays whole."""
    n = batch.num_rows
    if not n:
        return
    rows = max(1, int(n * most / max(1, batch.nbytes)))
    for at in range(0, n, rows):
        part = batch.slice(at, rows)
        if part.num_rows > 1 and part.nbytes > 4 * most:
            yield from by_bytes(part.take(pa.array(range(part.num_rows // 2))), most)
            yield from by_bytes(part.take(pa.array(range(part.num_rows // 2, part.num_rows))), most)
        else:
            yield part


def _tidy() -> None:
    """Give freed memory back to the system: an idle worker would keep it while others need it."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def in_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with batches of bounded bytes.

    Spark's own bound on batches, which its session holds, is set to ``MAX_BATCH_BYTES``: else 10,000 long texts
    would stand in memory at once, on both sides.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", MAX_BATCH_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            _tidy()

    return df.mapInArrow(run, schema)


def squeeze(text: str) -> bytes:
    """``text`` compressed by itself, for a shuffle."""
    raw = text.encode()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueeze(small: bytes) -> str:
    return pa.decompress(small[8:], decompressed_size=int.from_bytes(small[:8], "little"), codec="zstd", asbytes=True).decode()


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType) -> DataFrame:
    """``fn`` over byte-bounded record batches, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch):
                yield fn(part)

    return df.transform(in_arrow, run, schema)


def texts_of(batch: pa.RecordBatch, i: int) -> list[str]:
    """Column ``i`` as strings; null counts as empty."""
    return [x or "" for x in batch.column(i).to_pylist()]


def filter_arrow(df: DataFrame, text_col: str, keep: Callable[[list[str]], list[bool]]) -> DataFrame:
    """Rows of ``df``, all columns as they are, whose text ``keep`` says yes to. Map-only."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch):
                yield part.filter(pa.array(keep(texts_of(part, at)), pa.bool_()))

    return df.transform(in_arrow, run, df.schema)


def fitted(sample: DataFrame, fit: Callable[[list, list], Any]) -> Any:
    """``fit`` of the two columns of a sample of bounded size, on one worker; the driver gets the model alone.

    The rows go in the order of a digest of both columns, so that no partitioning changes the model.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = [], []
        for batch in batches:
            x += batch.column(0).to_pylist()
            y += batch.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(x, y))], pa.binary())], names=["model"])

    one = sample.repartition(1).sortWithinPartitions(F.xxhash64(*sample.columns), *sample.columns)
    got = one.transform(in_arrow, run, "model binary").first()
    return pickle.loads(got["model"]) if got else fit([], [])
