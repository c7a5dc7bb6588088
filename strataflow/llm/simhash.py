"""SimHash near-dedup by multi-index hashing."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strataflow.llm.arrow import exclusive, map_arrow
from strataflow.llm.bitmaps import bitmap_of, only_passing
from strataflow.llm.components import connected_components
from strataflow.llm.scratch import discard, settle, stored

#: Words of a shingle, seed of its digest, and differing bits up to which fingerprints link.
WORDS, SEED, RADIUS = 3, 42, 3
#: Distinct fingerprints in a bucket from which it is split by the bytes of the other half.
HOT_BUCKET = 64
#: What the second half's keys have on top.
SECOND = 1 << 32

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_ODD = re.compile(rb"[\x09-\x0D]|  |^ | $")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """64-bit SimHash: a bit is 1 if it is set in more than half of the shingles' digests; 0 without a word."""
    raw = text.encode().translate(_LOWER)
    if _ODD.search(raw):
        raw = b" ".join(_WORD.findall(raw))
    if not raw:
        return 0
    cut = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 32)
    n = len(cut) + 1
    starts = [0, *(cut + 1).tolist()]
    ends = [*cut.tolist(), len(raw)]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(raw[a:b], seed) for a, b in zip(starts, ends[words - 1 :], strict=False)] if n >= words else [digest(raw, seed)], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 65536):
        ones += np.unpackbits(h[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """``id_col`` and ``fp`` (long, the bits of the fingerprint) of each row; a null text has fingerprint 0. Map-only."""
    schema = StructType([StructField(id_col, df.schema[id_col].dataType), StructField("fp", LongType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        exclusive("SimHash")
        fps = np.array([fingerprint(x or "", words, seed) for x in batch.column(1).to_pylist()], dtype=np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=schema.names)

    return map_arrow(df.select(F.col(id_col), F.col(text_col)), run, schema)


def _half(fp: Column, k: int) -> Column:
    """Half ``k`` of a fingerprint, 0 to 2**32 - 1."""
    return F.shiftrightunsigned(fp, 32) if k else fp.bitwiseAND(F.lit(0xFFFFFFFF))


def links(classes: DataFrame, radius: int = RADIUS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Pairs ``a``, ``b`` (a < b) of different fingerprints ``fp`` that differ in at most ``radius`` (3) bits.

    Of the two 32-bit halves of such a pair one differs in at most one bit. Each fingerprint is
    kept in a table under both halves, and looks up the ball of radius 1 around each of its
    halves: the half itself, and every half with one more bit set, which finds each pair from one
    side. Matches are verified on all 64 bits.

    A bucket with more than ``hot_bucket`` fingerprints is keyed by a byte of the other half too:
    that half differs in at most three bits, so that one of its four bytes is equal. No match is
    lost, and copies that share one half don't meet in one pair of rows each.
    """
    if radius > 3:
        raise ValueError("halves with balls of radius 1 find pairs of up to 3 differing bits")
    fps = classes.select("fp").distinct()
    # A key is a half with its number above it; what else a row needs follows from fingerprint and key.
    table = fps.select("fp", F.explode(F.array(_half(F.col("fp"), 0), _half(F.col("fp"), 1) + SECOND)).alias("key"))
    steps = F.array(*[F.lit(b).cast("long") for b in (0, *(1 << i for i in range(32)))])
    probes = table.select(F.col("fp").alias("q"), "key", F.explode(steps).alias("bit")).filter(F.col("key").bitwiseAND(F.col("bit")) == 0).select("q", F.col("key").bitwiseOR(F.col("bit")).alias("key"))
    hot = table.groupBy("key").count().filter(F.col("count") > hot_bucket).select("key")
    same = F.when(F.col("key") >= SECOND, _half(F.col("q"), 1) + SECOND).otherwise(_half(F.col("q"), 0)) == F.col("key")
    near = (F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= radius) & (~same | (F.col("q") < F.col("fp")))

    def by_byte(rows: DataFrame, fp: str) -> DataFrame:
        other = F.when(F.col("key") >= SECOND, _half(F.col(fp), 0)).otherwise(_half(F.col(fp), 1))
        return rows.select(fp, "key", F.explode(F.array(*[F.shiftright(other, 8 * i).bitwiseAND(F.lit(255)) + 256 * i for i in range(4)])).alias("byte"))

    # Sizes are estimated without the 17-fold probes: a broadcast chosen by them would be of any size.
    # Merge joins on the same key also let both paths share one shuffle of the probes.
    cold = probes.join(table.join(hot, "key", "left_anti").hint("merge"), "key").filter(near).select("q", "fp")
    warm = by_byte(probes.join(hot.hint("merge"), "key", "left_semi"), "q").join(by_byte(table.join(hot, "key", "left_semi"), "fp").hint("merge"), ["key", "byte"]).filter(near).select("q", "fp")
    return cold.union(warm).select(F.least("q", "fp").alias("a"), F.greatest("q", "fp").alias("b")).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, seed: int = SEED, radius: int = RADIUS) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` of each row.

    Rows link if their fingerprints differ in at most ``radius`` bits; ``component_id`` is the
    smallest id that links lead to. Equal fingerprints are one class from the start, so that
    copies cost one look-up. Null and wordless texts have fingerprint 0 and link like any other;
    a null id takes part without being a smallest id (null if its whole component has none);
    repeated rows stay; an empty table gives an empty result.
    """
    fps = stored(fingerprints(df, id_col, text_col, words, seed), "fingerprints")
    classes = stored(fps.groupBy("fp").agg(F.min(id_col).alias("low")), "classes")
    of = connected_components(links(classes, radius))
    low = classes.join(of, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("component", "fp").alias("component"))
    least = low.groupBy("component").agg(F.min("low").alias("component_id"))
    named = low.select("fp", "component").join(least, "component").select("fp", "component_id")
    out = fps.join(named, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
    out._stored_at = (*fps._stored_at, *classes._stored_at, *of._stored_at)  # for whoever has no more use for it
    return out


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of near-duplicates, that of the smallest id; all columns as they are.

    Rows without an id stay if no row with an id is linked to them. Of rows that repeat the smallest
    id the one with the smallest hash of its text stays. Columns may have any names. Rows whose id is kept, and found once, pass through the scan; a bitmap of the other
    ids tells them apart, so that only rows to drop, repeated ones and few others are shuffled.
    """
    components = near_duplicates(df, id_col, text_col)
    settle(df.sparkSession)
    of = stored(components, "components")
    discard(components)
    first = of.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(id_col) == F.col("component_id")).alias("stays"), F.count("*").alias("n"))
    doubtful = stored(first.filter("not stays or n > 1").select("id", "stays", F.xxhash64("id").alias("key")), "doubtful")
    marks = bitmap_of(doubtful, "key")
    settle(df.sparkSession)
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("own"), F.col(id_col).alias("id"), F.xxhash64(id_col).alias("key"), F.xxhash64(text_col).alias("tie"))
    marked = rows.filter("id is not null")
    sure = only_passing(marked, "key", marks, False).select("own")
    rest = only_passing(marked, "key", marks).join(doubtful.select("id", "stays"), "id", "left").filter(F.coalesce("stays", F.lit(True)))
    kept = sure.union(rest.groupBy("id").agg(F.min_by("own", "tie").alias("own")).select("own"))
    if of.filter(F.col(id_col).isNull() & F.col("component_id").isNull()).limit(1).count():
        lone = of.filter(F.col(id_col).isNull() & F.col("component_id").isNull()).select("fingerprint").distinct()
        null_rows = rows.filter("id is null").select("own", F.monotonically_increasing_id().alias("row"))
        keys = fingerprints(null_rows.select("row", F.col("own").getField(text_col).alias("text")), "row", "text")
        alone = keys.select("row", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")).join(lone, "fingerprint", "left_semi").select("row")
        kept = kept.union(null_rows.join(alone, "row", "left_semi").select("own"))
    return kept.select("own.*")
