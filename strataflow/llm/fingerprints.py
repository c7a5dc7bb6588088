"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests."""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, BooleanType, DataType, DoubleType, IntegerType, IntegralType, LongType, StringType, StructField, StructType

from strataflow.llm.arrow import by_bytes, in_arrow, squeeze, unsqueeze
from strataflow.llm.segments import paragraph_spans

#: Cells that a digest goes to; cells of a fingerprint; factor by which a failed peeling grows the sketch.
HASHES, CELLS, GROWTH = 3, 18, 2
#: Documents whose sketches are peeled together; rows a range that its bounds are estimated from.
BLOCK, SAMPLE = 512, 40


def digests(text: str) -> np.ndarray:
    """64-bit digest of each paragraph; the k-th copy of a paragraph in a text has a digest of its own."""
    seen: dict[str, int] = {}
    out = []
    for a, b in paragraph_spans(text):
        p = text[a:b]
        k = seen[p] = seen.get(p, -1) + 1
        out.append(xxhash.xxh3_64_intdigest(f"{p}\0{k}" if k else p))
    return np.unique(np.array(out, dtype=np.uint64))  # equal digests would cancel, and peeling never end


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sketches:
    """Invertible Bloom lookup tables side by side: table t has ``sizes[t]`` cells from ``starts[t]`` on.

    A cell holds the signed number of digests put in, the xor of them and the xor of their checks.
    """

    def __init__(self, sizes: np.ndarray) -> None:
        self.sizes = np.asarray(sizes, dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        n = int(self.starts[-1])
        self.count, self.keys, self.checks = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)

    def _cells(self, owner: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Places (hash x key): hash i has the i-th third of a table."""
        third = self.sizes[owner] // HASHES
        return np.stack([self.starts[owner] + i * third + (_mix(keys, i + 1) % third.astype(np.uint64)).astype(np.int64) for i in range(HASHES)])

    def put(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray | int) -> None:
        at = self._cells(owner, keys)
        check = _mix(keys, 9)
        for row in at:
            np.add.at(self.count, row, sign)
            np.bitwise_xor.at(self.keys, row, keys)
            np.bitwise_xor.at(self.checks, row, check)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(self.sizes)
        out.count, out.keys, out.checks = self.count - other.count, self.keys ^ other.keys, self.checks ^ other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Take out every digest that stands alone in a cell, until none does.

        Returns owner, digest and sign of what came out, and which tables are empty in the end:
        those are fully recovered.
        """
        table_of = np.repeat(np.arange(len(self.sizes)), self.sizes)
        owners, found, signs = [], [], []
        look = np.arange(len(self.count))
        while len(look):
            pure = look[(np.abs(self.count[look]) == 1) & (_mix(self.keys[look], 9) == self.checks[look])]
            if not len(pure):
                break
            owner, key, sign = table_of[pure], self.keys[pure], self.count[pure]
            _, first = np.unique(np.stack([owner.astype(np.uint64), key]), axis=1, return_index=True)
            owner, key, sign = owner[first], key[first], sign[first]
            owners.append(owner)
            found.append(key)
            signs.append(sign)
            self.put(owner, key, -sign)
            look = np.unique(self._cells(owner, key))
        rest = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        failed = np.zeros(len(self.sizes), dtype=bool)
        failed[table_of[rest]] = True
        none = np.zeros(0, np.int64)
        return (np.concatenate(owners) if owners else none, np.concatenate(found) if found else none.astype(np.uint64), np.concatenate(signs) if signs else none, ~failed)


def sketch(items: list[np.ndarray], sizes: np.ndarray) -> Sketches:
    out = Sketches(sizes)
    if items:
        out.put(np.repeat(np.arange(len(items)), [len(x) for x in items]), np.concatenate(items), 1)
    return out


def serialized(items: list[np.ndarray], cells: int = CELLS) -> list[str]:
    """The fingerprint of each set of digests: their number and the cells of a sketch of ``cells`` cells, as base64."""
    s = sketch(items, np.full(len(items), cells))
    out = []
    for t, x in enumerate(items):
        at = slice(s.starts[t], s.starts[t + 1])
        raw = len(x).to_bytes(4, "little") + s.count[at].astype("<u4").tobytes() + s.keys[at].astype("<u8").tobytes() + s.checks[at].astype("<u4").tobytes()
        out.append(base64.b64encode(raw).decode())
    return out


def differences(a: list[np.ndarray], b: list[np.ndarray], cells: int = CELLS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pair of sets, the digests that only the first and only the second has.

    Sketches of ``cells`` cells are subtracted and peeled; the pairs that fail are sketched again,
    ``GROWTH`` times larger, until all are recovered. A sketch that starts too small for the
    difference in the sets' sizes is enlarged at once.
    """
    out: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64))] * len(a)
    open_ = list(range(len(a)))
    sizes = np.array([max(cells, 3 * (abs(len(x) - len(y)) // 2 + 1)) for x, y in zip(a, b, strict=True)], dtype=np.int64)
    while open_:
        size = sizes[open_]
        rest = sketch([a[i] for i in open_], size).minus(sketch([b[i] for i in open_], size))
        owner, key, sign, done = rest.peel()
        order = np.argsort(owner, kind="stable")
        owner, key, sign = owner[order], key[order], sign[order]
        edge = np.searchsorted(owner, np.arange(len(open_) + 1))
        for t, i in enumerate(open_):
            if done[t]:
                k, s = key[edge[t] : edge[t + 1]], sign[edge[t] : edge[t + 1]]
                out[i] = (k[s > 0], k[s < 0])
        open_ = [i for t, i in enumerate(open_) if not done[t]]
        sizes[open_] *= GROWTH
    return out


def likeness(a: list[np.ndarray], b: list[np.ndarray], cells: int = CELLS) -> list[float]:
    """Shared share of the union of each two sets, from their recovered difference; 1 for two empty sets."""
    out = []
    for x, y, (more, less) in zip(a, b, differences(a, b, cells), strict=True):
        union = (len(x) + len(y) + len(more) + len(less)) / 2
        out.append(1.0 - (len(more) + len(less)) / union if union else 1.0)
    return out


def fingerprint_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS) -> DataFrame:
    """``id_col`` and ``fingerprint`` of each row's whole text; a null text counts as empty. Map-only."""
    schema = StructType([StructField(id_col, df.schema[id_col].dataType), StructField("fingerprint", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch):
                got = serialized([digests(x or "") for x in part.column(1).to_pylist()], cells)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(got, pa.string())], names=schema.names)

    return df.select(F.col(id_col), F.col(text_col)).transform(in_arrow, run, schema)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of code points replaced by the first as many of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _order_key(kind: DataType) -> tuple[DataType, int | str]:
    """Type in which ids are ordered, and what stands for a null one: whole numbers as such, others as strings."""
    return (LongType(), -(1 << 63)) if isinstance(kind, IntegralType) else (StringType(), "")


def ordered_neighbours(df: DataFrame, id_col: str, text_col: str, parts: int | None = None) -> DataFrame:
    """Rows dealt by ranges of (id, digest of the text, any digest of the row's place), each range with a row like the one that follows its last.

    Ranges are cut at quantiles of a sample of ``SAMPLE`` rows a range, so that rows of one id, and even equal rows,
    take several ranges if they are many. Three scans, one of which shuffles the rows, with
    their texts compressed; the driver sees the sample and a row for each range. Columns: ``range``, ``guest``
    (the row belongs to the following range; each task sends one), ``i`` (null ids first), ``tie``, ``id_col`` and ``packed``.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind, none = _order_key(df.schema[id_col].dataType)
    keyed = df.select(F.col(id_col), F.col(text_col), F.coalesce(F.col(id_col).cast(kind), F.lit(none)).alias("i"), F.xxhash64(text_col).alias("tie"))
    keys = keyed.select("i", "tie", F.xxhash64(F.monotonically_increasing_id()).alias("spread"))
    n = df.select(F.col(id_col)).count()
    sample = sorted(tuple(r) for r in (keys if n <= SAMPLE * parts else keys.sample(SAMPLE * parts / n, 1)).collect())
    cuts = sorted({sample[len(sample) * k // parts] for k in range(1, parts)} if sample else set())
    i_type, names = (pa.int64() if isinstance(kind, LongType) else pa.string()), ["range", "i", "tie"]

    def ranges(part: pa.RecordBatch, at: int) -> list[int]:
        """Number of the cuts up to each row, which begin ranges."""
        return [bisect_right(cuts, key) for key in zip(*[part.column(at + k).to_pylist() for k in range(3)], strict=True)]

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low: dict[int, tuple] = {}
        for batch in batches:
            for r, i, tie in zip(ranges(batch, 0), batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if r not in low or (i, tie) < low[r]:
                    low[r] = (i, tie)
        rows = [(r, *key) for r, key in low.items()]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate((pa.int32(), i_type, pa.int64()))], names=names)

    first = keys.transform(in_arrow, lowest, StructType([StructField("range", IntegerType()), StructField("i", kind), StructField("tie", LongType())]))
    firsts = sorted((r["range"], r["low"]["i"], r["low"]["tie"]) for r in first.groupBy("range").agg(F.min(F.struct("i", "tie")).alias("low")).collect())
    hosts: dict[tuple, list[int]] = {}  # ranges that a row like this one follows
    for before, (_, i, tie) in zip(firsts[-1:] + firsts[:-1], firsts, strict=True):
        hosts.setdefault((i, tie), []).append(before[0])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple] = set()
        for batch in batches:
            for part in by_bytes(batch):
                to, row, guest = ranges(part, 2), list(range(part.num_rows)), [False] * part.num_rows
                for at, key in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)):
                    if key in hosts and key not in sent:
                        sent.add(key)
                        for r in hosts[key]:
                            to.append(r)
                            row.append(at)
                            guest.append(True)
                packed = pa.array([squeeze(x or "") for x in part.column(1).to_pylist()], pa.binary())
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(guest), part.column(2).take(take), part.column(3).take(take), part.column(0).take(take), packed.take(take)], names=["range", "guest", "i", "tie", id_col, "packed"])

    schema = StructType([StructField("range", IntegerType()), StructField("guest", BooleanType()), StructField("i", kind), StructField("tie", LongType()), StructField(id_col, df.schema[id_col].dataType), StructField("packed", BinaryType())])
    dealt = keyed.withColumn("spread", F.xxhash64(F.monotonically_increasing_id())).transform(in_arrow, deal, schema)
    return dealt.repartitionById(len(cuts) + 1, F.col("range")).sortWithinPartitions("guest", "i", "tie")


def compare_with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS) -> DataFrame:
    """Fingerprint each row's text and an edited text, and compare with that and with the next row.

    The next row is the one with the next id (after the last, the first). Rows of equal id follow
    each other by a hash of their texts; null ids come first; ids that are no whole numbers are ordered as strings; a
    single row is its own next. Null texts count as empty. Returns ``id_col``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``. One shuffle of the texts; a worker holds
    a block of rows at a time.
    """
    kind = df.schema[id_col].dataType
    schema = StructType([StructField(id_col, kind), StructField("n_chars", LongType()), StructField("edited_sha256", StringType()), StructField("fingerprint", StringType()), StructField("edited_fingerprint", StringType()), StructField("near_edited", DoubleType()), StructField("near_next", DoubleType())])
    arrow_kind = to_arrow_type(kind)

    def block(ids: list, texts: list[str], sets: list[np.ndarray]) -> pa.RecordBatch:
        """Rows of all texts but the last, which only follows."""
        changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
        own, new = sets[:-1], [digests(t) for t in changed]
        return pa.RecordBatch.from_arrays([
            pa.array(ids[:-1], arrow_kind), pa.array([len(t) for t in texts[:-1]], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array(serialized(own, cells), pa.string()), pa.array(serialized(new, cells), pa.string()), pa.array(likeness(own, new, cells), pa.float64()), pa.array(likeness(own, sets[1:], cells), pa.float64()),
        ], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, sets, size, ended = [], [], [], 0, False
        for batch in batches:
            for part in by_bytes(batch):
                for guest, doc, small in zip(part.column(1).to_pylist(), part.column(4).to_pylist(), part.column(5).to_pylist(), strict=True):
                    if ended:
                        continue  # what other tasks sent for the following range's first row
                    ended = guest
                    text = unsqueeze(small)
                    ids.append(doc)
                    texts.append(text)
                    sets.append(digests(text))
                    size += len(text)
                    if len(ids) > BLOCK or size > 4 << 20 and len(ids) > 1:
                        yield block(ids, texts, sets)
                        ids, texts, sets, size = ids[-1:], texts[-1:], sets[-1:], len(text)
        if len(ids) > 1:
            yield block(ids, texts, sets)

    return ordered_neighbours(df, id_col, text_col).transform(in_arrow, run, schema)
