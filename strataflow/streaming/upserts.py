"""Prospective updates: a stream of records put over a table, batch by batch."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from strataflow.operators.latest import latest_by
from strataflow.operators.upsert import upsert
from strataflow.sinks.shared_folder import SharedFolder

#: Parts from which on a table is written as one.
MOST_PARTS = 16


class SnapshotTable:
    """A table in a folder that all executors share: parts of changed rows, and a log with an entry for each batch.

    A batch writes the rows that it changes, not the table. Its entry appears whole and once, under the batch's
    number: a batch that is replayed, by this writer or by another after a loss, finds it and does nothing more. Every
    ``MOST_PARTS`` batches the parts are written as one. Versions stay readable.
    """

    def __init__(self, spark: SparkSession, path: str, ddl: str, keys: Sequence[str]) -> None:
        self.spark, self.ddl, self.keys, self.files = spark, ddl, list(keys), SharedFolder(spark, path)

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names("_log") if n.endswith(".json")]

    def _parts(self, version: int | None = None) -> list[str]:
        """Parts of the last version, or of the last one up to ``version``."""
        last = max((v for v in self.versions() if version is None or v <= version), default=None)
        return [] if last is None else json.loads(self.files.read(f"_log/{last:020d}.json"))

    def _of(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.ddl)
        frames = [self.spark.read.schema(self.ddl).parquet(f"{self.files.uri}/{p}").withColumn("__part", F.lit(n)) for n, p in enumerate(parts)]
        if len(frames) == 1:
            return frames[0].drop("__part")
        return latest_by(reduce(DataFrame.unionByName, frames), self.keys, [F.desc("__part")]).drop("__part")

    def read(self, version: int | None = None) -> DataFrame:
        return self._of(self._parts(version))

    def put(self, batch: DataFrame, version: int, order: Sequence[Column], keep: Sequence[str] = ()) -> None:
        """Upsert a batch as ``version``; what has that number already stays as it is."""
        if version in self.versions():
            return
        parts = self._parts(version)
        met = self._of(parts).join(batch.select(*self.keys).distinct(), self.keys, "left_semi")
        name = f"v={version}-{uuid.uuid4().hex[:12]}"
        upsert(met, batch, self.keys, order, keep).write.parquet(f"{self.files.uri}/{name}")
        parts = [*parts, name]
        if len(parts) > MOST_PARTS:
            name = f"v={version}-{uuid.uuid4().hex[:12]}"
            self._of(parts).write.parquet(f"{self.files.uri}/{name}")
            parts = [name]
        self.files.put_new(f"_log/{version:020d}.json", json.dumps(parts).encode())


def upsert_stream(stream: DataFrame, table: SnapshotTable, order: Sequence[Column], keep: Sequence[str] = ()) -> DataStreamWriter:
    """A writer that applies each micro-batch as one upsert, under the batch's number; the caller sets checkpoint and trigger."""
    return stream.writeStream.foreachBatch(lambda batch, n: table.put(batch, n, order, keep))
