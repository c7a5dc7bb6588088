"""Substring dedup: paragraph MinHash banding, exact Jaccard, components; and exactly repeated passages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, ByteType, DataType, IntegerType, IntegralType, LongType, StringType, StructField, StructType

from strataflow.llm.arrow import by_bytes, exclusive, in_arrow, squeeze, unsqueeze
from strataflow.llm.bitmaps import bitmap_of, only_passing, passing
from strataflow.llm.components import connected_components
from strataflow.llm.scratch import discard, settle, stored

#: Words of a shingle, least Jaccard similarity, least words of a paragraph that is compared.
SHINGLE, SIMILARITY, LEAST_WORDS = 5, 0.8, 20
#: Chance that a pair at exactly SIMILARITY collides in a band, which the bands are tuned for, with ROWS minima in each.
RECALL, ROWS = 0.98, 2
#: Least words of an exact repeat that is removed, and words of the windows that find it.
RUN_WORDS, SEED_WORDS = 50, 20

#: Kinds of rows: a stretch from a chosen window to the end of the next, the stretch ahead of the first one, a line; a single window, a line's shingles.
STRETCH, HEAD, LINE = 0, 1, 2
WINDOW, SHINGLES = 3, 4
#: Lines of a band outside its largest group up to which they are compared with all others of the band: with more, some hundred shingles of each line cost less.
HARD_BAND = 512
#: Bytes of texts that are cut together.
PART_BYTES = 1 << 19

#: What ``dedup_substrings`` adds to ids and carried columns.
SPANS = ("text", "changed", "n_removed_words", "spans", "keeper_id")

_U = np.uint64
_P, _Q = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_GAP = np.isin(np.arange(256), [32, *range(9, 14)])
SKETCH = ("s0", "s1", "s2", "s3")


def tune_bands(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> int:
    """Fewest bands of ``rows`` minima in which a pair of that similarity collides with chance ``recall``."""
    bands = 1
    while 1 - (1 - similarity**rows) ** bands < recall:
        bands += 1
    return bands


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number modulo 2**64, and their inverses."""
    got = _POWERS.get(base)
    if got is None or len(got[0]) < n:
        size = max(n, 4096)
        size = 1 << (size - 1).bit_length()
        up, down = np.full(size, base, dtype=_U), np.full(size, pow(base, -1, 1 << 64), dtype=_U)
        up[0] = down[0] = 1
        up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        got = _POWERS[base] = (up, down)
    return got


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Digests:
    """Digest of any ``values[start:end]``, the same wherever it stands."""

    def __init__(self, values: np.ndarray, base: int) -> None:
        self._base = base
        up, self._down = _powers(base, len(values) + 1)
        self._sums = np.concatenate([np.zeros(1, _U), np.cumsum(values * up[: len(values)], dtype=_U)])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mix((self._sums[ends] - self._sums[starts]) * self._down[starts] + (ends - starts).astype(_U) * _U(self._base))


def _within(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every place from start to end of each range, one range after the other, and where each range begins among them."""
    size = ends - starts
    first = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])[:-1].astype(np.int64)
    return np.repeat(starts - first, size) + np.arange(int(size.sum())), first


class Parts:
    """Words, lines and chosen windows of texts that stand one after the other; none crosses from one to the next.

    Words are known by their place among all of them, bytes by their place in their own text.
    """

    def __init__(self, texts: list[str]) -> None:
        raw = [t.encode() for t in texts]
        b = np.frombuffer(b"".join(x + b"\n" for x in raw), dtype=np.uint8)
        base = np.concatenate([[0], np.cumsum([len(x) + 1 for x in raw])]).astype(np.int64)
        gap = np.concatenate([[True], _GAP[b], [True]])
        turn = np.flatnonzero(gap[1:] != gap[:-1])
        starts, ends = turn[::2], turn[1::2]
        self.n = len(starts)
        first = np.searchsorted(starts, base)  # first word of each text
        self.doc = np.repeat(np.arange(len(raw)), np.diff(first))
        self.first, self.last = first[self.doc], first[self.doc + 1]  # of each word's text
        self.start, self.end = starts - base[self.doc], ends - base[self.doc]
        if not self.n:
            self.line_starts = self.line_ends = np.zeros(0, np.int64)
            return
        words = _Digests(b.astype(_U) + _U(1), _P)(starts, ends)
        self.digest = _Digests(words, _Q)
        line = np.searchsorted(np.flatnonzero(b == 10), starts)
        self.line_ends = np.concatenate([np.flatnonzero(line[1:] != line[:-1]) + 1, [self.n]])
        self.line_starts = np.concatenate([[0], self.line_ends[:-1]])

    def windows(self, k: int) -> np.ndarray:
        """Digest of the k words that begin at each word; those that cross from one text to the next mean nothing."""
        i = np.arange(max(0, self.n - k + 1))
        return self.digest(i, i + k)

    def stretches(self, k: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First word of each chosen window of k words, digest of that window, end and digest of the stretch that begins there, digest of the stretch before.

        Windows are chosen so that every ``run`` words in a row have one. A stretch ends where the next
        chosen window ends, or with its text; the one before the first begins with its text.
        """
        w = self.windows(k)
        i = np.arange(max(0, self.n - run + 1))
        at = chosen(w, run - k + 1, self.doc[i] == self.doc[i + run - 1])
        if not len(at):
            none = np.zeros(0, _U)
            return at, none, at, none, none
        more = self.doc[at[1:]] == self.doc[at[:-1]]
        end = self.last[at]
        end[:-1][more] = at[1:][more] + k
        h, prev = self.digest(at, end), self.digest(self.first[at], at + k)
        prev[1:][more] = h[:-1][more]
        return at, w[at], end, h, prev

    def lines(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last word (exclusive) of each line of ``least`` words or more."""
        ok = self.line_ends - self.line_starts >= least
        return self.line_starts[ok], self.line_ends[ok]


def chosen(windows: np.ndarray, width: int, valid: np.ndarray | None = None) -> np.ndarray:
    """Places of the least digest, the last of equal ones, of each ``width`` windows in a row (winnowing).

    ``valid`` says at which windows such a row may begin; by default all do, and fewer windows than
    ``width`` are one row.
    """
    n = len(windows)
    if not n or valid is not None and not len(valid):
        return np.zeros(0, dtype=np.int64)
    low = _U((1 << 24) - 1)
    key = (_mix(windows) & ~low) | (low - (np.arange(n, dtype=_U) & low))
    width, have = min(width, n), 1
    while have < width:
        step = min(have, width - have)
        key = np.minimum(key[:-step], key[step:])
        have += step
    at = np.arange(len(key)) if valid is None else np.flatnonzero(valid)
    return np.unique(at + ((low - (key[at] & low)).astype(np.int64) - at) % (1 << 24))


def _minhash(shingles: np.ndarray, starts: np.ndarray, ends: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band keys (lines x bands) of the shingles from start to end of each line."""
    inside, first = _within(starts, ends)
    flat = shingles[inside]
    out = np.zeros((len(starts), bands), dtype=_U)
    for band in range(bands):
        key = np.full(len(starts), band + 1, dtype=_U)
        for row in range(rows):  # digests are mixed: an odd factor orders them anew
            odd = pow(_P, band * rows + row + 1, 1 << 64) | 1
            key = _mix(key * _U(_P) ^ np.minimum.reduceat(flat * _U(odd), first))
        out[:, band] = key
    return out


def _sketches(shingles: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Four words of the parities of each line's distinct shingles: no more bits differ between two lines than shingles do."""
    word, bit = shingles >> _U(62), _U(1) << (shingles >> _U(56) & _U(63))
    return [np.bitwise_xor.reduceat(np.where(word == _U(k), bit, _U(0)), first).view(np.int64) for k in range(4)]


def _key_type(df: DataFrame, id_col: str) -> DataType:
    """Type in which ids are compared: long for whole numbers, else string."""
    return LongType() if isinstance(df.schema[id_col].dataType, IntegralType) else StringType()


def _least(kind: DataType) -> int | str:
    """What stands for a null id."""
    return -(1 << 63) if isinstance(kind, LongType) else ""


def _keyed(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``doc`` (the id; the least one for null), ``version`` (64-bit digest of the text), ``text``, ``dk`` and ``rk`` (digests of doc and of both) and what else is asked for."""
    kind = _key_type(df, id_col)
    rows = df.select(F.coalesce(F.col(id_col).cast(kind), F.lit(_least(kind))).alias("doc"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"), *more)
    return rows.select("*", F.xxhash64("doc").alias("dk"), F.xxhash64("doc", "version").alias("rk"))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(x).view(np.int64) if x.dtype == _U else x.astype(np.int64), pa.int64())


def _int(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.int32), pa.int32())


def _batch(schema: list[tuple[str, pa.DataType]], n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """Columns that are not given are null."""
    return pa.RecordBatch.from_arrays([columns[name] if name in columns else pa.nulls(n, kind) for name, kind in schema], names=[name for name, _ in schema])


def _arrow(kind: DataType) -> pa.DataType:
    return pa.int64() if isinstance(kind, LongType) else pa.string()


def passage_table(df: DataFrame, id_col: str, text_col: str, bands: int, rows: int, least_words: int = LEAST_WORDS, run: int = RUN_WORDS, k: int = SEED_WORDS) -> DataFrame:
    """A row for each stretch and each line of ``least_words`` words or more: ``kind``, ``doc``, ``version``, ``start``, ``stop``, ``h``.

    ``start`` and ``stop`` are bytes, ``h`` a digest of the words. A stretch has also the digests of its
    first window, ``seed``, and of the stretch before it, ``prev``; a line its ``bands``. Map-only.
    """
    kind = _key_type(df, id_col)
    schema = StructType([StructField("kind", ByteType()), StructField("doc", kind), StructField("version", LongType()), StructField("start", IntegerType()), StructField("stop", IntegerType()), StructField("h", LongType()), StructField("seed", LongType()), StructField("prev", LongType()), StructField("bands", ArrayType(LongType()))])
    kinds = list(zip(schema.names, [pa.int8(), _arrow(kind), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())], strict=True))

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exclusive("substring dedup", _POWERS.clear)
        for batch in batches:
            for part in by_bytes(batch, PART_BYTES):
                p = Parts([t or "" for t in part.column(2).to_pylist()])
                if not p.n:
                    continue

                def made(what: int, at: np.ndarray, end: np.ndarray, **columns: pa.Array) -> pa.RecordBatch:
                    doc = pa.array(p.doc[at])  # noqa: B023
                    own = {"kind": pa.array(np.full(len(at), what, np.int8)), "doc": part.column(0).take(doc), "version": part.column(1).take(doc), "start": _int(p.start[at]), "stop": _int(p.end[end - 1])}  # noqa: B023
                    return _batch(kinds, len(at), own | columns)

                at, seed, end, h, prev = p.stretches(k, run)
                if len(at):
                    yield made(STRETCH, at, end, h=_long(h), seed=_long(seed), prev=_long(prev))
                    one = np.concatenate([[True], p.doc[at[1:]] != p.doc[at[:-1]]])
                    yield made(HEAD, p.first[at[one]], at[one] + k, h=_long(prev[one]), seed=_long(seed[one]))
                a, z = p.lines(least_words)
                if len(a):
                    keys = _minhash(p.windows(SHINGLE), a, z - SHINGLE + 1, bands, rows)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1) * bands, pa.int32()), _long(keys.ravel()))
                    yield made(LINE, a, z, h=_long(p.digest(a, z)), bands=lists)

    return _keyed(df, id_col, text_col).select("doc", "version", "text").transform(in_arrow, run_, schema)


def details(df: DataFrame, id_col: str, text_col: str, docs: Broadcast, ends: Broadcast, lines: Broadcast, least_words: int = LEAST_WORDS, run: int = RUN_WORDS, k: int = SEED_WORDS) -> DataFrame:
    """A second look at the rows in question: windows about the ends of runs, and lines' shingle sets.

    ``docs`` is a bitmap of ``dk``; ``ends`` of a stretch's digest xor ``dk``, inverted if the run may go on
    behind its first window instead of ahead of its last one; ``lines`` of a line's digest xor ``dk``. Each
    window of ``k`` words that is fewer than the width of the choice away from such a chosen one is listed with ``doc``,
    ``version``, ``start``, ``stop`` and ``h``; each such line with ``h``, ``size``, ``shingles`` (distinct)
    and a sketch of them, ``s0`` to ``s3``.
    """
    kind = _key_type(df, id_col)
    schema = StructType([StructField("kind", ByteType()), StructField("doc", kind), StructField("version", LongType()), StructField("start", IntegerType()), StructField("stop", IntegerType()), StructField("h", LongType()), StructField("size", IntegerType()), StructField("shingles", ArrayType(LongType())), *[StructField(c, LongType()) for c in SKETCH]])
    kinds = list(zip(schema.names, [pa.int8(), _arrow(kind), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), *[pa.int64()] * 4], strict=True))
    reach = run - k

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exclusive("substring dedup", _POWERS.clear)
        for batch in batches:
            for whole in by_bytes(batch, PART_BYTES):
                part = whole.filter(pa.array(passing(docs.value, whole.column(3).to_numpy())))
                p = Parts([t or "" for t in part.column(2).to_pylist()])
                if not p.n:
                    continue
                dk = part.column(3).to_numpy().view(_U)
                at, _, _, h, prev = p.stretches(k, run)
                if len(at):
                    own = dk[p.doc[at]]
                    before, behind = at[passing(ends.value, prev ^ own)], at[passing(ends.value, ~(h ^ own))]
                    near = np.zeros(p.n + 1, dtype=np.int64)
                    np.add.at(near, np.concatenate([np.maximum(before - reach, p.first[before]), behind]), 1)
                    np.add.at(near, np.concatenate([before + 1, np.minimum(behind + reach + 1, p.last[behind] - k + 1)]), -1)
                    i = np.flatnonzero(np.cumsum(near[:-1]) > 0)
                    if len(i):
                        doc = pa.array(p.doc[i])
                        yield _batch(kinds, len(i), {"kind": pa.array(np.full(len(i), WINDOW, np.int8)), "doc": part.column(0).take(doc), "version": part.column(1).take(doc), "start": _int(p.start[i]), "stop": _int(p.end[i + k - 1]), "h": _long(p.digest(i, i + k))})
                a, z = p.lines(least_words)
                if len(a):
                    h = p.digest(a, z)
                    ok = passing(lines.value, h ^ dk[p.doc[a]])
                    a, z, h = a[ok], z[ok], h[ok]
                if len(a):
                    inside, first = _within(a, z - SHINGLE + 1)
                    line, flat = np.repeat(np.arange(len(a)), z - SHINGLE + 1 - a), p.digest(inside, inside + SHINGLE)
                    order = np.lexsort((flat, line))
                    line, flat = line[order], flat[order]
                    new = np.concatenate([[True], (line[1:] != line[:-1]) | (flat[1:] != flat[:-1])])
                    line, flat = line[new], flat[new]
                    size = np.bincount(line, minlength=len(a))
                    edge = np.concatenate([[0], np.cumsum(size)])
                    sets = pa.ListArray.from_arrays(_int(edge), _long(flat))
                    yield _batch(kinds, len(a), {"kind": pa.array(np.full(len(a), SHINGLES, np.int8)), "h": _long(h), "size": _int(size), "shingles": sets} | {c: pa.array(x) for c, x in zip(SKETCH, _sketches(flat, edge[:-1]), strict=True)})

    return _keyed(df, id_col, text_col).select("doc", "version", "text", "dk").transform(in_arrow, run_, schema)


def earlier(rows: DataFrame, name: str, but: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``doc``, ``version``, ``start``, ``stop`` and ``keeper`` of the rows whose digest a smaller id has too, the smallest being the keeper; and the table of those digests, less those of ``but``.

    The digests are a table of their own, so that a join of many rows with one of them can be split.
    """
    twice = rows.groupBy("h").agg(F.min("doc").alias("keeper"), F.max("doc").alias("last")).filter("keeper < last").select("h", "keeper")
    repeated = stored(twice if but is None else twice.join(but, "h", "left_anti"), name)
    hits = only_passing(rows.select("h", "doc", "version", "start", "stop"), "h", bitmap_of(repeated, "h"))
    return hits.join(repeated, "h").filter("doc > keeper").select("doc", "version", "start", "stop", "keeper"), repeated


def open_ends(stretches: DataFrame) -> DataFrame:
    """``key`` and ``doc``: on which side of which chosen windows, and in which row, a run may go on for a part of a stretch.

    Rows that have a chosen window in common fall into classes by the stretch ahead of it, and by the one
    that begins with it. A side with one class has nothing open; of a class with others beside it the row of the smallest
    id speaks for all, as the whole stretch repeats it in the others. ``key`` is the stretch's digest xor that of the id,
    inverted on the side behind.
    """
    sides = stretches.select("seed", "doc", F.explode(F.array(F.struct(F.lit(False).alias("behind"), F.col("prev").alias("x")), F.struct(F.lit(True).alias("behind"), F.col("h").alias("x")))).alias("s")).select("seed", "doc", "s.behind", "s.x")
    classes = sides.groupBy("seed", "behind", "x").agg(F.min("doc").alias("doc"))
    several = classes.groupBy("seed", "behind").agg(F.min("x").alias("low"), F.max("x").alias("high")).filter("low < high").select("seed", "behind")
    key = F.col("x").bitwiseXOR(F.xxhash64("doc"))
    return classes.join(several, ["seed", "behind"]).select(F.when(F.col("behind"), F.bitwise_not(key)).otherwise(key).alias("key"), "doc")


def _close(x: str, y: str, similarity: float) -> Column:
    """Whether sketches and sizes leave a similarity possible: no similar pair fails this."""
    apart = sum((F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))) for c in SKETCH), F.lit(0))
    return apart <= (1 - similarity) / (1 + similarity) * (F.col(f"{x}.size") + F.col(f"{y}.size")) + 1e-6


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a``, ``b`` of line digests whose shingle sets have that Jaccard similarity at least. Sets follow only pairs that their sketches leave possible."""
    brief, full = sets.select("h", "size", *SKETCH), sets.select("h", "shingles")
    close = pairs.join(brief.select(F.col("h").alias("a"), F.struct("size", *SKETCH).alias("x")), "a").join(brief.select(F.col("h").alias("b"), F.struct("size", *SKETCH).alias("y")), "b").filter(_close("x", "y", similarity)).select("a", "b")
    both = close.join(full.select(F.col("h").alias("a"), F.col("shingles").alias("x")), "a").join(full.select(F.col("h").alias("b"), F.col("shingles").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.filter(common >= similarity * (F.size("x") + F.size("y") - common)).select("a", "b")


def band_members(table: DataFrame) -> DataFrame:
    """``band``, ``h``, ``n`` and ``doc``: the distinct lines of each band that has two different ones, with the number of their rows and the smallest id that has them.

    A band's members are first only compared as the smallest and the largest digest, in partial
    aggregates; bands with two different ones, and few others, are read again.
    """
    banded = table.filter(F.col("kind") == LINE).select("h", "doc", F.explode("bands").alias("band"))
    marks = bitmap_of(banded.groupBy("band").agg(F.min("h").alias("low"), F.max("h").alias("high")).filter("low < high"), "band")
    members = stored(only_passing(banded, "band", marks).groupBy("band", "h").agg(F.count("*").alias("n"), F.min("doc").alias("doc")), "members")
    marks.destroy()
    return members


def _labels(links: DataFrame) -> DataFrame:
    """``h`` and ``label`` of each line with a link, equal only for lines that links connect: the smallest of those at most two links away."""
    both = links.select("a", "b").union(links.select("b", "a"))
    first = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label"))
    return both.join(first.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("label").alias("near")).join(first, "a").select(F.col("a").alias("h"), F.least("near", "label").alias("label"))


def sharing_rare_shingles(lines: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs ``a``, ``b`` of lines (h, label, size, sketch) with different labels that may be similar: none that is, is lost.

    A line's shingles are ordered by how few of the lines have them. Two lines with a Jaccard similarity of t share at least t of
    each one's shingles, and so one of the rarest 1 - t and one more of both (prefix filtering). What a shingle's lines have in
    common among those rarest is never common to many of them.
    """
    each = stored(lines.select("h").join(sets.select("h", F.explode("shingles").alias("s")), "h"), "shingles")
    held = each.join(each.groupBy("s").agg(F.count("*").alias("n")).filter("n > 1"), "s", "left").select("h", "s", F.coalesce("n", F.lit(1)).alias("n"))
    ordered = held.groupBy("h").agg(F.array_sort(F.collect_list(F.struct("n", "s"))).alias("all"))  # a line's own shingles
    prefix = F.size("all") - F.ceil(similarity * F.size("all") - 1e-9).cast("int") + 1
    rare = ordered.select("h", F.explode(F.slice("all", 1, prefix)).alias("r")).filter("r.n > 1").select("h", F.col("r.s").alias("s")).join(lines, "h")
    x, y = rare.alias("x"), rare.alias("y")
    met = (F.col("x.s") == F.col("y.s")) & (F.col("x.h") < F.col("y.h")) & (F.col("x.label") != F.col("y.label")) & _close("x", "y", similarity)
    return x.join(y, met).select(F.col("x.h").alias("a"), F.col("y.h").alias("b"))


def near_lines(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links ``a``, ``b`` between digests of different lines with a Jaccard similarity of at least ``similarity``.

    They connect every two such lines that share a band, without a comparison of all pairs of a band. First each
    member is compared with the most frequent line of its band, which edited copies are nearest to. Members
    that are then connected need no further comparison; so only bands with members of several such groups go
    on, and in those each member outside the largest group is compared with those of other groups, if there are no
    more than ``HARD_BAND`` such; a band with more is gone through by ``sharing_rare_shingles``. So a band
    of n lines costs some n comparisons, whether they are like one of them or like none.
    """
    centres = members.groupBy("band").agg(F.max_by("h", F.struct("n", "h")).alias("a"), F.count("*").alias("lines")).filter("lines > 1").select("band", "a")
    first = stored(similar(members.join(centres, "band").filter("h != a").select("a", F.col("h").alias("b")).distinct(), sets, similarity), "links")
    settle(members.sparkSession)
    grouped = members.select("band", "h").join(_labels(first), "h", "left").select("band", "h", F.coalesce("label", "h").alias("label"))
    sizes = grouped.groupBy("band", "label").count().groupBy("band").agg(F.max_by("label", F.struct("count", "label")).alias("largest"), F.count("*").alias("groups"), F.sum("count").alias("members"), F.max("count").alias("most")).filter("groups > 1").drop("groups")
    mixed = stored(grouped.join(sizes, "band").join(sets.select("h", "size", *SKETCH), "h"), "mixed")
    few = mixed.filter(F.col("members") - F.col("most") <= HARD_BAND)
    x, y = few.filter("label != largest").alias("x"), few.alias("y")
    other = (F.col("x.label") != F.col("y.label")) & ((F.col("y.label") == F.col("y.largest")) | (F.col("x.h") < F.col("y.h")))
    rest = x.join(y, (F.col("x.band") == F.col("y.band")) & other & _close("x", "y", similarity)).select(F.least("x.h", "y.h").alias("a"), F.greatest("x.h", "y.h").alias("b"))
    hard = mixed.filter(F.col("members") - F.col("most") > HARD_BAND)
    if hard.limit(1).count():
        rest = rest.union(sharing_rare_shingles(hard.dropDuplicates(["h"]).select("h", "label", "size", *SKETCH), sets, similarity))
    rest = rest.distinct()
    settle(members.sparkSession)
    links = stored(first.union(similar(rest, sets, similarity)), "links")
    discard(first, mixed)
    return links


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, least_words: int = LEAST_WORDS, run_words: int = RUN_WORDS) -> DataFrame:
    """What repeats an earlier row: ``doc``, ``version`` and ``found``, an array of (line, start, stop, keeper).

    Those with ``line`` are equal to an earlier line, or in a component of near-equal lines; of the others, stretches and windows repeat
    exactly. The keeper is the smallest id that has them, or a line of the component; it keeps them all.

    Every run of ``run_words`` words that two rows share has a chosen window, and from its first
    to its last one the same stretches in both. Its ends, where a chosen window's neighbouring stretches differ
    among the rows that have it, are compared window by window. So all its words are found, whatever
    other rows share of it. Tables that are no longer needed are deleted.
    """
    table = stored(passage_table(df, id_col, text_col, tune_bands(similarity), ROWS, least_words, run_words), "passages")
    seeds = table.filter(F.col("kind") == STRETCH).groupBy("seed").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high")
    marks = bitmap_of(seeds, "seed")
    stretches = stored(only_passing(table.filter(F.col("kind") < LINE).drop("bands"), "seed", marks), "stretches")
    marks.destroy()
    members = band_members(table)
    wanted = members.groupBy("h").agg(F.min("doc").alias("doc"))
    asked = stored(open_ends(stretches.filter(F.col("kind") == STRETCH)).withColumn("line", F.lit(False)).union(wanted.select(F.col("h").bitwiseXOR(F.xxhash64("doc")).alias("key"), "doc").withColumn("line", F.lit(True))), "asked")
    bitmaps = [bitmap_of(asked.select(F.xxhash64("doc").alias("dk")), "dk"), bitmap_of(asked.filter("not line"), "key"), bitmap_of(asked.filter("line"), "key")]
    second = stored(details(df, id_col, text_col, *bitmaps, least_words, run_words), "details")
    for b in bitmaps:
        b.destroy()
    sets = second.filter(F.col("kind") == SHINGLES).dropDuplicates(["h"])  # rows of equal id list a line again
    settle(df.sparkSession)
    links = near_lines(members, sets, similarity)
    components = connected_components(links)
    settle(df.sparkSession)
    named = stored(components.withColumnRenamed("node", "h"), "named")
    marks = bitmap_of(named, "h")
    lines = stored(only_passing(table.filter(F.col("kind") == LINE).select("doc", "version", "start", "stop", "h"), "h", marks).join(named, "h"), "lines")
    marks.destroy()
    keepers = stored(lines.groupBy("component").agg(F.min("doc").alias("keeper")), "keepers")
    near = lines.join(keepers, "component").filter("doc > keeper").select("doc", "version", "start", "stop", "keeper")
    same, third = earlier(table.filter(F.col("kind") == LINE), "equal", named)
    settle(df.sparkSession)
    (whole, first), (ends, second_) = earlier(stretches, "repeated"), earlier(second.filter(F.col("kind") == WINDOW), "ends")
    both = whole.union(ends).withColumn("line", F.lit(False)).union(near.union(same).withColumn("line", F.lit(True)))
    found = stored(both.groupBy("doc", "version").agg(F.collect_set(F.struct("line", "start", "stop", "keeper")).alias("found")), "found")
    discard(table, stretches, members, asked, second, links, components, named, lines, keepers, first, second_, third)
    settle(df.sparkSession)
    return found


def spans_to_remove(raw: bytes, found: list[dict], run_words: int = RUN_WORDS) -> list[tuple[int, int, int, object]]:
    """(start, stop, words, keeper) of each span of the UTF-8 ``raw`` to remove, ascending and apart.

    Repeats that overlap or follow each other are one; those of fewer than ``run_words`` words stay, unless
    a near-equal line is among them.
    """
    out: list[list] = []
    for f in sorted(found, key=lambda f: (f["start"], -f["stop"])):
        if out and (f["start"] <= out[-1][1] or not raw[out[-1][1] : f["start"]].strip(b" \t\r\n\f\v")):
            out[-1][1] = max(out[-1][1], f["stop"])
            out[-1][3].append(f)
        else:
            out.append([f["start"], f["stop"], f["keeper"], [f]])
    spans: list[tuple[int, int, int, object]] = []
    for a, b, keeper, parts in out:
        words = len(raw[a:b].split())
        if words >= run_words:
            spans.append((a, b, words, keeper))
        else:
            spans += [(f["start"], f["stop"], len(raw[f["start"] : f["stop"]].split()), f["keeper"]) for f in parts if f["line"]]
    return spans


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the spans of its UTF-8; of the white space around each the wider stays."""
    raw, out, at = text.encode(), [], 0
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    out.append(raw[at:])
    kept = [p.decode() for p in out]
    gaps = " \t\r\n\f\v"
    text = kept[0]
    for p in kept[1:]:
        bare, rest = text.rstrip(gaps), p.lstrip(gaps)
        between = text[len(bare) :] + p[: len(p) - len(rest)]
        text = bare + ("\n" if "\n" in between else " " if between else "") + rest if bare and rest else bare + rest
    return text


def dedup_substrings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, least_words: int = LEAST_WORDS, run_words: int = RUN_WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each row with its text less what repeats a row of a smaller id.

    Returns ``id_col``, ``text``, ``changed``, ``n_removed_words``, ``spans`` (array of start and stop in
    bytes of the text as it came, words, and keeper, an id) and ``keeper_id`` (of the first span; null
    if none), and ahead of them the columns named in ``carry``, which may not be named like these. Two things are removed: lines (paragraphs)
    of ``least_words`` words or more that equal a line of an earlier row, or whose 5-word shingles have a Jaccard
    similarity of ``similarity`` or more with a line linked to an earlier row; and exact repeats of ``run_words`` words
    or more, wherever they stand in a line, word for word. Shorter exact repeats within lines stay unless they adjoin
    others and have as many words together. Repeats within a row stay, as do those between rows of equal id. A null text stays null; null
    ids count as one smallest id; ids that are no whole numbers are compared as strings; repeated rows are treated
    alike; an empty table gives an empty result. Only texts with something to remove, and few others, are
    shuffled, compressed, to their spans; what leads to those shuffles numbers.
    """
    found = repeated_spans(df, id_col, text_col, similarity, least_words, run_words)
    touched = bitmap_of(found.select(F.xxhash64("doc", "version").alias("rk")), "rk")
    if clash := {id_col, *SPANS} & {*carry}:
        raise ValueError(f"columns of the result cannot be carried: {sorted(clash)}")
    rows = _keyed(df, id_col, text_col, F.struct(*[F.col(c) for c in (*carry, id_col)]).alias("__own")).select("__own", "text", "doc", "version", "rk")
    kind = _key_type(df, id_col)
    key = kind.simpleString()
    span = f"array<struct<start:int,stop:int,words:int,keeper:{key}>>"
    own_type = rows.schema["__own"].dataType
    schema = f"__own {own_type.simpleString()}, text string, changed boolean, n_removed_words long, spans {span}, keeper_id {key}"
    span_kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("words", pa.int32()), ("keeper", _arrow(kind))]))

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.filter(pa.array(~passing(touched.value, batch.column(4).to_numpy())))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["__own", "text"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.filter(pa.array(passing(touched.value, batch.column(4).to_numpy())))
            texts = [None if t is None else squeeze(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.binary()), part.column(2), part.column(3)], names=["__own", "packed", "doc", "version"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, PART_BYTES):
                texts, changed, removed, spans, keeper = [], [], [], [], []
                for small, f in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    text = None if small is None else unsqueeze(small)
                    s = spans_to_remove(text.encode(), f, run_words) if f and text else []
                    texts.append(without(text, [x[:2] for x in s]) if s else text)
                    changed.append(bool(s))
                    removed.append(sum(x[2] for x in s))
                    spans.append([dict(zip(("start", "stop", "words", "keeper"), x, strict=True)) for x in s])
                    keeper.append(s[0][3] if s and s[0][3] != _least(kind) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), pa.array(changed, pa.bool_()), pa.array(removed, pa.int64()), pa.array(spans, span_kind), pa.array(keeper, _arrow(kind))], names=["__own", "text", "changed", "n_removed_words", "spans", "keeper_id"])

    rest = rows.transform(in_arrow, plain, StructType([StructField("__own", own_type), StructField("text", StringType())]))
    rest = rest.select("__own", "text", F.lit(False).alias("changed"), F.lit(0).cast("long").alias("n_removed_words"), F.array().cast(span).alias("spans"), F.lit(None).cast(kind).alias("keeper_id"))
    small = rows.transform(in_arrow, packed, StructType([StructField("__own", own_type), StructField("packed", BinaryType()), StructField("doc", kind), StructField("version", LongType())]))
    joined = small.join(found, ["doc", "version"], "left").select("__own", "packed", "found")
    out = rest.union(joined.transform(in_arrow, cut, schema))
    return out.select("__own.*", *SPANS)
