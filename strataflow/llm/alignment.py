"""Cross-tokenizer alignment: token ends of two tokenizers merged per document, links counted over the corpus."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from strataflow.llm.arrow import by_bytes, exclusive, in_arrow
from strataflow.llm.scratch import discard, stored
from strataflow.llm.token_counts import SPACE, SegmentCounter

#: Segments, and characters of segments, that a worker remembers; beyond either it forgets the seldom used ones.
MEMO_ENTRIES, MEMO_CHARS = 250_000, 8 << 20
#: Characters of texts that are gone through at once.
BLOCK_CHARS = 1 << 19
#: New segments that are encoded as one text.
RUN_SEGMENTS = 64
#: A pair with at least this share of all links is broadcast; no more than its inverse can have it.
HOT_SHARE = 1 / 65_536

#: Both tokenizers start a new token at a space behind a character that is neither white space nor the marker.
_CUT = re.compile(f"(?<=[^\\s{SPACE}]) ")


def merge_ends(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Two-pointer merge of the cumulative ends of two tokenizers' tokens: how many of each come before each common end."""
    out = []
    i = j = 0
    while i < len(a) and j < len(b):
        x, y = a[i], b[j]
        i += x <= y
        j += y <= x
        if x == y:
            out.append((i, j))
    return out


class Alignment(NamedTuple):
    """Tokens of both sides, groups, their digest, and the distinct links (``a << 32 | b``) with how often each occurs."""

    n_a: int
    n_b: int
    n_groups: int
    groups_sha256: str
    pairs: np.ndarray
    times: np.ndarray


NONE = Alignment(0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))


class _State:
    """What is known of a text whose blocks are still being gone through."""

    def __init__(self) -> None:
        self.ok, self.digest, self.total = True, hashlib.sha256(), np.zeros(3, dtype=np.int64)
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def done(self) -> Alignment:
        if not self.ok:
            return NONE
        pair, where = np.unique(np.concatenate(self.pairs), return_inverse=True)
        n = np.bincount(where, np.concatenate(self.times), len(pair)).astype(np.int64)
        return Alignment(*self.total.tolist(), self.digest.hexdigest(), pair, n)


def _spans(edge: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of lists ``rows``, one behind the other, and where each list then ends."""
    size = edge[rows + 1] - edge[rows]
    ends = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(edge[rows] - ends[:-1], size) + np.arange(ends[-1]), ends


class Aligner:
    """Aligns texts under a byte-level BPE (A, of a space and the text) and a SentencePiece model (B, which puts a space before).

    Texts are cut at spaces where both start a new token, if the models allow it (see ``SegmentCounter``), and
    each different segment is encoded once, many new ones behind one another.
    """

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer, decoders, pre_tokenizers

        self._a = Tokenizer.from_file(a_path)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        plain = self._a.normalizer is None and type(self._a.pre_tokenizer) is pre_tokenizers.ByteLevel and type(self._a.decoder) is decoders.ByteLevel and not self._a.pre_tokenizer.add_prefix_space
        self.safe = plain and SegmentCounter(b_path).safe
        self._lone = self._b.encode("a ")[len(self._b.encode("a")) :] if self.safe else []
        self._a_bytes = self._byte_level(self._a.get_vocab())
        self._b_bytes = [self._piece(self._b.id_to_piece(i)) for i in range(self._b.get_piece_size())]
        self._a_size, self._b_size = (np.array([*map(len, x)]) for x in (self._a_bytes, self._b_bytes))
        ids = np.arange(max(len(self._a_bytes), len(self._b_bytes)))
        self._names = np.array([f"{i}{sign}" for i in ids.tolist() for sign in ",|;"], dtype="S").view(np.uint8).reshape(3 * len(ids), -1)
        self._name_size = (self._names > 0).sum(axis=1)
        self._forget()

    @staticmethod
    def _byte_level(vocab: dict[str, int]) -> list[bytes]:
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [x for x in range(256) if x not in plain]
        byte_of = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(rest)}
        out = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            out[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        return out

    @staticmethod
    def _piece(piece: str) -> bytes:
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace(SPACE, " ").encode()

    def _forget(self) -> None:
        self._place: dict[str, int] = {}
        self._groups: list[bytes | None] = []
        self._counts = np.zeros((1 << 12, 3), dtype=np.int64)
        self._uses = np.zeros(1 << 12, dtype=np.int64)
        self._edge = np.zeros(1, dtype=np.int64)
        self._links = np.zeros(0, dtype=np.int64)
        self._chars = 0

    def _shrink(self) -> None:
        """Keep the segments used most, half as many as there is room for."""
        keep = np.argsort(-self._uses[: len(self._groups)], kind="stable")[: MEMO_ENTRIES // 2]
        room, names = MEMO_CHARS // 2, list(self._place)
        kept = []
        for k in keep.tolist():
            if self._uses[k] > 1 and len(names[k]) <= room:
                room -= len(names[k])
                kept.append(k)
        old = self.__dict__.copy()
        self._forget()
        at = np.array(kept, dtype=np.int64)
        self._place = {names[k]: i for i, k in enumerate(kept)}
        self._groups = [old["_groups"][k] for k in kept]
        self._counts = np.concatenate([old["_counts"][at], self._counts])
        self._uses = np.concatenate([old["_uses"][at] // 2, self._uses])
        spans, self._edge = _spans(old["_edge"], at)
        self._links = old["_links"][spans]
        self._chars = MEMO_CHARS // 2 - room

    def align_segment(self, segment: str, a: list[int], b: list[int]) -> tuple[bytes | None, list[int]]:
        """Groups as text, and linked ids as ``a << 32 | b``; no groups if the tokens do not spell a space and the segment."""
        want = f" {segment}".encode()
        a_bytes, b_bytes = [self._a_bytes[i] for i in a], [self._b_bytes[i] for i in b]
        if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            return None, []
        groups, links = [], []
        i = j = 0
        for x, y in merge_ends([*accumulate(map(len, a_bytes))], [*accumulate(map(len, b_bytes))]):
            groups.append(f"{','.join(map(str, a[i:x]))}|{','.join(map(str, b[j:y]))}")
            links.append(a[x - 1] << 32 | b[y - 1])
            i, j = x, y
        return ";".join(groups).encode(), links

    def _encode(self, texts: list[str]) -> Iterator[tuple[str, list[int], list[int]]]:
        a = self._a.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)
        for t, x, y in zip(texts, a, self._b.encode(texts, num_threads=1), strict=True):
            yield t, x.ids, y if t else self._lone

    def _align_alone(self, segments: list[str]) -> tuple[list[bytes | None], np.ndarray, np.ndarray]:
        """Of each segment its groups and its counts (tokens of both sides, links); the links, one segment's behind the other's."""
        groups, counts, flat = [], [], []
        for s, a, b in self._encode(segments):
            own, links = self.align_segment(s, a, b)
            groups.append(own)
            counts.append((len(a), len(b), len(links)))
            flat += links
        return groups, np.array(counts, dtype=np.int64).reshape(-1, 3), np.array(flat, dtype=np.int64)

    def _align_runs(self, segments: list[str]) -> tuple[list[str], list[bytes], np.ndarray, np.ndarray, list[str]]:
        """``_align_alone`` for segments that may follow one another in a text: runs of them are encoded, common ends found in arrays.

        The segments aligned come first, those of runs whose tokens do not spell them last.
        """
        runs = [segments[k : k + RUN_SEGMENTS] for k in range(0, len(segments), RUN_SEGMENTS)]
        done, rest, a_ids, b_ids = [], [], [], []
        for run, (text, a, b) in zip(runs, self._encode([" ".join(r) for r in runs]), strict=True):
            want = f" {text}".encode()
            if b"".join(map(self._a_bytes.__getitem__, a)) == want == b"".join(map(self._b_bytes.__getitem__, b)):
                done += run
                a_ids.append(a)
                b_ids.append(b)
            else:
                rest += run
        a, b = (np.fromiter(chain.from_iterable(x), np.int64, sum(map(len, x))) for x in (a_ids, b_ids))
        a_ends, b_ends = np.cumsum(self._a_size[a]), np.cumsum(self._b_size[b])
        edge = np.cumsum(pc.binary_length(pa.array(done, pa.large_string())).to_numpy() + 1)
        at = np.searchsorted(b_ends, a_ends)
        a_last = b_ends[at] == a_ends
        i, j = np.flatnonzero(a_last), at[a_last]
        ends = a_ends[i]
        n = np.searchsorted(ends, edge)
        if not (done and self._a_size[a].all() and self._b_size[b].all() and (ends[n] == edge).all()):
            return [], [], np.zeros((0, 3), dtype=np.int64), np.zeros(0, dtype=np.int64), segments
        b_last = np.zeros(len(b), dtype=bool)
        b_last[j] = True
        # a token stands behind those of its side, and those of the other side in the groups before (A) or up to its own (B)
        name = np.empty(len(a) + len(b), dtype=np.int64)
        name[np.arange(len(a)) + np.concatenate([[0], j + 1])[np.cumsum(a_last) - a_last]] = 3 * a + a_last
        name[np.arange(len(b)) + i[np.cumsum(b_last) - b_last] + 1] = 3 * b + 2 * b_last
        signs = self._names[name]
        text = signs[signs > 0].tobytes()
        stop = np.cumsum(self._name_size[name])[i[n] + j[n] + 1].tolist()
        groups = [text[x : y - 1] for x, y in zip([0, *stop], stop)]
        counts = np.diff(np.stack([i[n], j[n], n], axis=1), axis=0, prepend=-1)
        return done, groups, counts, a[i] << 32 | b[j], rest

    def _learn(self, segments: list[str]) -> None:
        if len(self._place) > MEMO_ENTRIES or self._chars > MEMO_CHARS:
            self._shrink()
        new = list(set(segments).difference(self._place))
        if not new:
            return
        # a cut has no white space and no marker before it, and the marker is no text that tokens spell
        joined = [s for s in new if SPACE not in s and s and not s[-1].isspace()] if self.safe else []
        alone = [s for s in new if SPACE in s or not s or s[-1].isspace()] if self.safe else new
        done, groups, counts, links, rest = self._align_runs(joined)
        alone += rest
        more_groups, more_counts, more_links = self._align_alone(alone)
        counts = np.concatenate([counts, more_counts])
        first = len(self._groups)
        self._groups += groups + more_groups
        self._place.update(zip(chain(done, alone), range(first, len(self._groups)), strict=True))
        self._chars += sum(map(len, new))
        last = len(self._groups)
        if last > len(self._counts):
            more = max(last, 2 * len(self._counts)) - len(self._counts)
            self._counts = np.concatenate([self._counts, np.zeros((more, 3), dtype=np.int64)])
            self._uses = np.concatenate([self._uses, np.zeros(more, dtype=np.int64)])
        self._counts[first:last] = counts
        self._edge = np.concatenate([self._edge, self._edge[-1] + np.cumsum(counts[:, 2])])
        self._links = np.concatenate([self._links, links, more_links])

    def _blocks(self, text: str) -> Iterator[list[str]]:
        """Segments of a text, those of a block at once."""
        at = 0
        while self.safe and len(text) - at > BLOCK_CHARS and (m := _CUT.search(text, at + BLOCK_CHARS)):
            yield _CUT.split(text[at : m.start()])
            at = m.end()
        yield _CUT.split(text[at:]) if self.safe else [text[at:]]

    def documents(self, texts: list[str]) -> list[Alignment]:
        """Each text's alignment; ``NONE`` for one without tokens."""
        state = [_State() for _ in texts]
        held: list[tuple[int, list[str]]] = []
        chars = 0
        for i, text in enumerate(texts):
            if not text:
                state[i].ok = False
                continue
            for segments in self._blocks(text):
                held.append((i, segments))
                chars += min(len(text), BLOCK_CHARS)
                if chars >= BLOCK_CHARS:
                    self._add(held, state)
                    held, chars = [], 0
        self._add(held, state)
        return [s.done() for s in state]

    def _add(self, held: list[tuple[int, list[str]]], state: list[_State]) -> None:
        if not held:
            return
        flat = [s for _, segments in held for s in segments]
        self._learn(flat)
        at = np.fromiter(map(self._place.__getitem__, flat), np.int64, len(flat))
        edge = np.cumsum([0, *(len(segments) for _, segments in held)])
        key, n = np.unique(np.repeat(np.arange(len(held)), np.diff(edge)) << 40 | at, return_counts=True)
        block, seg = key >> 40, key & (1 << 40) - 1
        np.add.at(self._uses, seg, n)
        spans, ends = _spans(self._edge, seg)
        pair, place = np.unique(self._links[spans], return_inverse=True)
        size = np.diff(ends)
        both, where = np.unique(np.repeat(block, size) * (len(pair) + 1) + place, return_inverse=True)
        times = np.bincount(where, np.repeat(n, size), len(both)).astype(np.int64)
        cut = np.searchsorted(both, np.arange(len(held) + 1) * (len(pair) + 1))
        places = at.tolist()
        for k, (i, _) in enumerate(held):
            own = state[i]
            groups = [self._groups[p] for p in places[edge[k] : edge[k + 1]]]
            if not own.ok or None in groups:
                own.ok = False
                continue
            if own.total[0]:
                own.digest.update(b";")
            own.digest.update(b";".join(groups))
            own.total += self._counts[at[edge[k] : edge[k + 1]]].sum(axis=0)
            own.pairs.append(pair[both[cut[k] : cut[k + 1]] % (len(pair) + 1)])
            own.times.append(times[cut[k] : cut[k + 1]])


@lru_cache(maxsize=2)
def _aligner(a_path: str | None, b_path: str | None) -> Aligner:
    import public_tokenizers

    return Aligner(a_path or public_tokenizers.path("byte_bpe_50k.json"), b_path or public_tokenizers.path("piece_bpe_32k.model"))


def token_links(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Each row's alignment: ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``groups_sha256``, and its distinct links.

    ``pairs`` has the linked ids as ``a * 2**32 + b``, ``times`` how often each occurs. One output row per input row;
    a text that is null, empty, or not spelled by either tokenizer's tokens has zeros, '' and no links. Map-only, in
    Arrow batches; a text is gone through in blocks, and what a worker keeps of it is bounded by its different links.
    """
    longs = ("n_a", "n_b", "n_groups")
    schema = StructType([StructField(id_col, df.schema[id_col].dataType), *(StructField(c, LongType()) for c in longs), StructField("groups_sha256", StringType()), *(StructField(c, ArrayType(LongType())) for c in ("pairs", "times"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exclusive("alignment", _aligner.cache_clear)
        for batch in batches:
            for part in by_bytes(batch):
                got = _aligner(a_path, b_path).documents([t or "" for t in part.column(1).to_pylist()])
                edge = pa.array(np.cumsum([0, *(len(x[4]) for x in got)]), pa.int32())
                lists = [pa.ListArray.from_arrays(edge, pa.array(np.concatenate([x[k] for x in got]))) for k in (4, 5)]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([x[k] for x in got], pa.int64()) for k in range(3)), pa.array([x[3] for x in got], pa.string()), *lists], names=schema.names)

    return df.select(id_col, text_col).transform(in_arrow, run, schema)


def link_counts(links: DataFrame) -> DataFrame:
    """Occurrences of each pair over all rows of ``token_links``, and whether it is the most frequent of its A or B id, ties included."""
    each = links.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.times").alias("n"))
    counts = stored(each.groupBy("pair").agg(F.sum("n").alias("count")), "links")
    sides = {"a": F.shiftright("pair", 32), "b": F.col("pair").bitwiseAND(0xFFFFFFFF)}
    out = counts.select("pair", "count", *(v.alias(k) for k, v in sides.items()))
    for k, v in sides.items():
        out = out.join(counts.groupBy(v.alias(k)).agg(F.max("count").alias(f"top_{k}")), k)
    return out.select("pair", "count", *((F.col("count") == F.col(f"top_{k}")).alias(f"best_{k}") for k in sides))


def align_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Alignment of each row's whole text under two tokenizers, with how usual its links are in all of ``df``.

    Returns ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` and ``n_best_a`` (links whose count is the
    highest of their B id, of their A id), ``count_sum`` (over links) and ``groups_sha256``. One output row per input
    row: repeated rows count each, null ids stay, other columns are not read, an empty table gives no row. Texts
    that are null, empty or not spelled by the tokens have zeros and ''.

    Texts are encoded once; the alignments are written, so that a lost executor costs a re-read. Counts
    of the pairs that have ``HOT_SHARE`` of all links, of which there can only be so many, come back by broadcast,
    those of all others by a join on the pair, none of which is frequent enough to fill a task.
    """
    rows = stored(token_links(df, id_col, text_col, a_path, b_path).withColumnRenamed(id_col, "__id").withColumn("__row", F.monotonically_increasing_id()), "alignment")
    counts = stored(link_counts(rows), "counts")
    total = counts.agg(F.sum("count").alias("n")).first()["n"] or 0
    hot: Column = F.col("count") >= F.lit(total * HOT_SHARE)
    each = rows.select("__row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("__row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("n"))
    usual = each.join(F.broadcast(counts.filter(hot)), "pair")
    rare = each.join(F.broadcast(counts.filter(hot).select("pair")), "pair", "left_anti").hint("merge").join(counts.filter(~hot), "pair")
    mine = (
        usual.unionByName(rare).groupBy("__row")
        .agg(F.sum("n").alias("n_links"), F.sum(F.col("n") * F.col("best_b").cast("long")).alias("n_best"), F.sum(F.col("n") * F.col("best_a").cast("long")).alias("n_best_a"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    )
    sums = ("n_links", "n_best", "n_best_a", "count_sum")
    out = rows.select("__row", "__id", "n_a", "n_b", "n_groups", "groups_sha256").join(mine, "__row", "left")
    done = stored(out.select(F.col("__id").alias(id_col), "n_a", "n_b", "n_groups", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in sums), "groups_sha256"), "aligned")
    discard(rows, counts)
    return done
