"""A folder of snapshot tables: each change writes the rows that it brings as a new part, and a log of commits says which parts count."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataflow.operators.latest import latest_by
from strataflow.operators.upsert import DuplicateKey, inserted, migrate, orphans, upsert
from strataflow.operators.validate import broken_constraints
from strataflow.schemas import KEYS, REFERENCES, RENAMED, TABLES, checks
from strataflow.sinks.shared_folder import SharedFolder

SCHEMA_VERSION = "6"
#: Parts of a table from which on they are written as one; the mark of a part whose rows may replace earlier ones.
MOST_PARTS, OVER = 16, "~"


class ConcurrentChange(RuntimeError):
    """Another writer has changed a table that this one was changing."""


class BrokenStore(RuntimeError):
    """An older store does not keep the rules of the tables that it would become."""


class Store:
    """Tables of ``schemas.TABLES`` as lists of parts, in a folder of any file system that all executors share.

    What a store is now is the last entry of a log of commits, each a file that appears whole and once. Changes inside
    ``transaction`` are one commit. A writer that finds its number taken looks at what the others changed: other tables
    are taken over and the next number is tried, the same table raises ``ConcurrentChange``. Nothing is locked, so that a
    writer that dies blocks nobody and leaves parts that no entry names.

    A store of an older version is migrated when it is opened: see ``_migrate``.
    """

    def __init__(self, spark: SparkSession, folder: str | Path) -> None:
        self.spark, self.files = spark, SharedFolder(spark, folder)
        self._staged: dict[str, str] | None = None
        self._log: dict[int, dict] = {}
        if not self._number():
            old = self._pointed()
            if old is None:
                part = f"1-{uuid.uuid4().hex[:12]}"
                self.frame("schema_meta", [("schema_version", SCHEMA_VERSION)]).write.parquet(self._path("schema_meta", part))
                old = {"schema_meta": part}
            self._put(1, old, sorted(old))  # whoever is first begins the log
        found = self.read("schema_meta").filter("key = 'schema_version'").first()
        version = found["value"] if found else "0"
        if int(version) > int(SCHEMA_VERSION):
            raise BrokenStore(f"the store has version {version}, this code knows {SCHEMA_VERSION}")
        if int(version) < int(SCHEMA_VERSION):
            self._migrate()

    def _pointed(self) -> dict[str, str] | None:
        """Parts of a store that still has a pointer file instead of a log."""
        return dict(x.split("=") for x in self.files.read("CURRENT").decode().split()) if "CURRENT" in self.files.names("") else None

    def _number(self) -> int:
        """Number of the last commit, 0 without one."""
        return max((int(n[:-5]) for n in self.files.names("_log") if n.endswith(".json")), default=0)

    def _entry(self, number: int) -> dict:
        if number not in self._log:
            self._log[number] = json.loads(self.files.read(f"_log/{number:020d}.json"))
        return self._log[number]

    def _put(self, number: int, tables: dict[str, str], changed: list[str]) -> bool:
        return self.files.put_new(f"_log/{number:020d}.json", json.dumps({"tables": tables, "changed": changed}, sort_keys=True).encode())

    def _versions(self) -> dict[str, str]:
        return self._staged if self._staged is not None else self._entry(self._number())["tables"]

    @contextmanager
    def transaction(self) -> Iterator[None]:
        if self._staged is not None:
            yield
            return
        base = self._number()
        seen = self._entry(base)["tables"]
        self._staged = dict(seen)
        try:
            yield
            mine = {t: v for t, v in self._staged.items() if seen.get(t) != v}
            while mine and not self._put(base + 1, self._entry(base)["tables"] | mine, sorted(mine)):
                base += 1
                both = sorted(mine.keys() & set(self._entry(base)["changed"]))
                if both:
                    raise ConcurrentChange(f"another writer has changed {', '.join(both)}")
        finally:
            self._staged = None

    def _migrate(self) -> None:
        """Bring an older store to this layout by one commit, or leave it as it was.

        What is old is read from the parts' footers. Parts that only lack columns stay and are read with nulls, beside
        newer ones; a part with a column of another type or name is written anew. Tables that have such parts must
        then keep their checks, and no row may lack the row that it refers to; else ``BrokenStore`` is raised.
        """
        with self.transaction():
            touched = []
            for table, listed in list(self._versions().items()):
                if table not in TABLES or not listed:
                    continue
                want = self.frame(table, []).schema
                parts = []
                for part in listed.split("."):
                    old = self.spark.read.parquet(self._path(table, part))
                    have = {f.name: f.dataType for f in old.schema}
                    names = {o: n for o, n in RENAMED.get(table, {}).items() if o in have}
                    if {f.name for f in want} != have.keys():
                        touched.append(table)
                    if names or any(f.name in have and have[f.name] != f.dataType for f in want):
                        anew = f"{part.split('-')[0]}-{uuid.uuid4().hex[:12]}" + OVER * part.endswith(OVER)
                        migrate(old.withColumnsRenamed(names), {f.name: f.dataType.simpleString() for f in want}).write.parquet(self._path(table, anew))
                        part = anew
                        touched.append(table)
                    parts.append(part)
                self._staged[table] = ".".join(parts)
            for table in sorted(set(touched)):
                broken = broken_constraints(self.read(table), checks(table), KEYS[table]).limit(3).collect()
                if broken:
                    raise BrokenStore(f"{table}: rows break {', '.join(sorted({c for r in broken for c in r['broken']}))}")
                for keys, parent in REFERENCES.get(table, ()):
                    if orphans(self.read(table), self.read(parent), keys).limit(1).count():
                        raise BrokenStore(f"{table}: rows without their {parent}")
            self.upsert("schema_meta", [("schema_version", SCHEMA_VERSION)])

    def _path(self, table: str, part: str) -> str:
        return f"{self.files.uri}/{table}/v={part.rstrip(OVER)}"

    def read(self, table: str) -> DataFrame:
        """The table as its parts say: of rows with one key the one in the latest part."""
        parts = self._versions().get(table, "").split(".")
        if parts == [""]:
            return self.spark.createDataFrame([], TABLES[table])
        reader = self.spark.read.schema(TABLES[table])
        if not any(p.endswith(OVER) for p in parts):
            return reader.parquet(*[self._path(table, p) for p in parts])
        frames = [reader.parquet(self._path(table, p)).withColumn("__part", F.lit(n)) for n, p in enumerate(parts)]
        return latest_by(reduce(DataFrame.unionByName, frames), KEYS[table], [F.desc("__part")]).drop("__part")

    def frame(self, table: str, rows: Sequence) -> DataFrame:
        return self.spark.createDataFrame(list(rows), TABLES[table])

    def _add(self, table: str, rows: DataFrame, over: bool = False, check: Callable[[DataFrame], None] | None = None) -> None:
        """Write one part more, which ``check`` may refuse; with ``MOST_PARTS`` of them, all as one."""
        parts = [p for p in self._versions().get(table, "").split(".") if p]
        number = int(parts[-1].split("-")[0]) + 1 if parts else 1
        name = lambda n: f"{n}-{uuid.uuid4().hex[:12]}"  # noqa: E731  no other writer has it
        part = name(number) + OVER * (over and bool(parts))
        rows.write.parquet(self._path(table, part))
        if check:
            check(self.spark.read.schema(TABLES[table]).parquet(self._path(table, part)))
        self._staged[table] = ".".join([*parts, part])
        if len(parts) >= MOST_PARTS:
            whole = name(number + 1)
            self.read(table).write.parquet(self._path(table, whole))
            self._staged[table] = whole

    def _frame(self, table: str, rows: DataFrame | Sequence) -> DataFrame:
        return rows if isinstance(rows, DataFrame) else self.frame(table, rows)

    def upsert(self, table: str, rows: DataFrame | Sequence, order: Sequence | None = None, keep: Sequence[str] = ()) -> None:
        """Only the rows that come, and what they keep, are written."""
        with self.transaction():
            new, keys = self._frame(table, rows), KEYS[table]
            met = self.read(table).join(new.select(*keys).distinct(), list(keys), "left_semi")
            self._add(table, upsert(met.select(*self.frame(table, []).columns), new, keys, order or list(keys), keep), over=True)

    def insert_ignore(self, table: str, rows: DataFrame | Sequence, order: Sequence | None = None) -> None:
        with self.transaction():
            self._add(table, inserted(self.read(table), self._frame(table, rows), KEYS[table], order or list(KEYS[table])))

    def append(self, table: str, rows: DataFrame | Sequence) -> None:
        """A key that is there already, or comes twice, raises, and nothing is added."""
        with self.transaction():
            before, keys = self.read(table), KEYS[table]

            def unique(new: DataFrame) -> None:
                twice = new.groupBy(*keys).count().filter("count > 1").select(*keys)
                if twice.union(new.select(*keys).join(before.select(*keys), list(keys), "left_semi")).limit(1).count():
                    raise DuplicateKey(f"repeated key in {', '.join(keys)}")

            self._add(table, self._frame(table, rows).select(*before.columns), check=unique)
