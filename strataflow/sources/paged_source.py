"""Counts and pages of a limited source, read by a fixed number of lanes that share its rate (SRC-05..07)."""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from strataflow.sources.paged import Remote, Source, Window

NAME = "paged_history"
#: Tasks that ask the source at the same time, each at its share of the rate.
LANES = 4


def in_lane(source: Source, lanes: int) -> Source:
    """The source as one of ``lanes`` tasks may use it."""
    return source.lane(lanes) if hasattr(source, "lane") else source


def _asked(requests: DataFrame, source: Source, lanes: int, answer: Callable[[Source, dict], dict], more: str, attempt: str = "error") -> DataFrame:
    """Each request with what ``answer`` says, or with its error: the others go on.

    Requests are dealt one by one to ``lanes`` partitions. As no more tasks than that can be at work, and each client has
    an equal share of the rate, the source is never asked faster than it allows, whatever runs late or again.
    """
    extra = StructType.fromDDL(more)
    schema = StructType([*requests.schema, *extra, StructField(attempt, StringType())])
    types = {"binary": pa.binary(), "bigint": pa.int64(), "string": pa.string()}
    names = requests.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = in_lane(source, lanes)
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                try:
                    got: dict = answer(client, row) | {attempt: None}
                except Exception as exc:  # kept with the request, which then counts as failed
                    got = {attempt: f"{type(exc).__name__}: {exc}"}
                columns = [pa.array([got.get(f.name)], types[f.dataType.simpleString()]) for f in extra] + [pa.array([got[attempt]], pa.string())]
                yield pa.RecordBatch.from_arrays([*batch.slice(i, 1).columns, *columns], names=[*names, *extra.names, attempt])

    return requests.repartition(lanes).mapInArrow(run, schema)


def _window(row: dict) -> Window:
    return Window(row["title"], row["slice_start"], row["slice_end"])


def read_counts(windows: DataFrame, source: Source, lanes: int = LANES) -> DataFrame:
    """``windows`` (title, slice_start, slice_end and others) with ``records``, ``handle`` and ``error``; no page is fetched."""

    def answer(client: Source, row: dict) -> dict:
        n, handle = client.opened(_window(row))
        return {"records": n, "handle": handle}

    return _asked(windows, source, lanes, answer, "records bigint, handle string")


def page_requests(counted: DataFrame, size: int) -> DataFrame:
    """A row per page of counted windows: where it begins, ``retstart``. Requests are planned by Spark, never listed by the driver."""
    if not 1 <= size <= 1000:
        raise ValueError("a page holds 1 to 1000 records")
    starts = F.filter(F.sequence(F.lit(0).cast("long"), F.greatest("records", F.lit(0).cast("long")), F.lit(size).cast("long")), lambda at: at < F.col("records"))
    return counted.withColumn("retstart", F.explode(starts))


def read_pages(requests: DataFrame, source: Source, size: int, lanes: int = LANES) -> DataFrame:
    """``requests`` (title, slice_start, slice_end, handle, retstart and others) with ``content`` and ``error``."""
    return _asked(requests, source, lanes, lambda client, row: {"content": client.page(_window(row), row["retstart"], size, row["handle"])}, "content binary")


@dataclass
class LanePartition(InputPartition):
    """What one lane asks for, in order: (title, start, end, retstart, handle); no retstart asks for the count."""

    requests: list[tuple[str, str, str, int | None, str | None]]


class PagedReader(DataSourceReader):
    """Counts, or pages by their starts, in as many partitions as there are lanes."""

    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> Sequence[InputPartition]:
        asked, lanes = json.loads(self.options["requests"]), int(self.options.get("lanes", LANES))
        return [LanePartition([tuple(r) for r in asked[k::lanes]]) for k in range(min(lanes, max(1, len(asked))))]

    def read(self, partition: LanePartition) -> Iterator[tuple]:
        made = self.options.get("client")
        if made:  # another client of the same interface, by its name
            module, name = made.split(":")
            source = getattr(importlib.import_module(module), name)()
        else:
            source = Remote(self.options["email"], self.options.get("api_key"))
        client, size = in_lane(source, int(self.options.get("lanes", LANES))), int(self.options.get("size", "200"))
        for title, start, end, at, handle in partition.requests:
            window = Window(title, date.fromisoformat(start), date.fromisoformat(end))
            if at is None:
                n, handle = client.opened(window)
                yield title, window.start, window.end, n, handle, None
            else:
                yield title, window.start, window.end, at, handle, client.page(window, at, size, handle)


class PagedSource(DataSource):
    """``title``, ``slice_start``, ``slice_end``, ``number`` (of records, or where a page begins), ``handle`` and a page's ``content``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "title string, slice_start date, slice_end date, number bigint, handle string, content binary"

    def reader(self, schema: object) -> PagedReader:
        return PagedReader(dict(self.options))


def read_windows(spark: SparkSession, windows: Sequence[Window], what: str = "pages", **options: object) -> DataFrame:
    """Numbers of records of windows that the driver lists, or their pages, through the data source: a count pass plans the pages' partitions."""
    spark.dataSource.register(PagedSource)

    def load(requests: list) -> DataFrame:
        return spark.read.format(NAME).options(requests=json.dumps(requests), **{k: str(v) for k, v in options.items()}).load()

    counts = load([(w.title, str(w.start), str(w.end), None, None) for w in windows])
    if what == "count":
        return counts.select("title", "slice_start", "slice_end", F.col("number").alias("records"))
    size = int(options.get("size", 200))
    planned = [(r["title"], str(r["slice_start"]), str(r["slice_end"]), at, r["handle"]) for r in counts.collect() for at in range(0, r["number"], size)]
    return load(planned).select("title", "slice_start", "slice_end", F.col("number").alias("retstart"), "content")
