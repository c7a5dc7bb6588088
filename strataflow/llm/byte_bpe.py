"""Byte-level BPE: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strataflow.llm.arrow import exclusive, map_arrow

#: Segments, and pre-tokens, whose ids a worker remembers, and the longest that it remembers.
MEMO_SEGMENTS, MEMO_PIECES, MEMO_CHARS = 400_000, 700_000, 48
#: The code points of Unicode's White_Space, which ``\s`` of the merge pattern means.
WHITE_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: A space between two characters that are no white space: no pre-token spans it from the left.
_CUT = re.compile(f"(?<=[^{WHITE_SPACE}]) (?=[^{WHITE_SPACE}])")
_ODD_SPACE = re.compile(f"[{WHITE_SPACE}] | [{WHITE_SPACE}]|^ | $")


class MinimalPerfectHash:
    """Hash and displace: n keys to n slots without a gap.

    Keys fall into buckets; large buckets first, each searches the displacement that sends its
    keys to free slots, and buckets of one key take a free slot directly.
    """

    def __init__(self, keys: list[bytes]) -> None:
        n = len(keys)
        self._n, self._buckets = n, max(1, n // 3)
        self.slots: list[bytes | None] = [None] * n
        self._shift = [0] * self._buckets
        groups: list[list[tuple[int, bytes]]] = [[] for _ in range(self._buckets)]
        for key in keys:
            h = xxhash.xxh3_128_intdigest(key)
            groups[h % self._buckets].append((h, key))
        order = sorted((b for b in range(self._buckets) if groups[b]), key=lambda b: -len(groups[b]))
        free = 0
        for b in order:
            group = groups[b]
            if len(group) == 1:
                while self.slots[free] is not None:
                    free += 1
                self._shift[b] = -1 - free
                self.slots[free] = group[0][1]
                continue
            d = 0
            while True:
                at = [self._place(h, d) for h, _ in group]
                if len(set(at)) == len(at) and all(self.slots[a] is None for a in at):
                    break
                d += 1
            self._shift[b] = d
            for a, (_, key) in zip(at, group, strict=True):
                self.slots[a] = key

    def _place(self, h: int, d: int) -> int:
        return ((h >> 64) + d * ((h >> 32 & 0xFFFFFFFF) | 1)) % self._n

    def find(self, key: bytes) -> int:
        """Slot of ``key``, or -1 if it isn't a key."""
        h = xxhash.xxh3_128_intdigest(key)
        d = self._shift[h % self._buckets]
        slot = -1 - d if d < 0 else self._place(h, d)
        return slot if self.slots[slot] == key else -1


class ByteBpe:
    """Encoder and decoder for a rank table, as its library encodes ordinary text."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self._ranks = ranks
        self._mph = MinimalPerfectHash(list(ranks))
        self._rank_of_slot = [ranks[k].to_bytes(4, "little") for k in self._mph.slots]
        self._pattern = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE_SPACE}").replace(r"\S", f"[^{WHITE_SPACE}]").replace(r"\s", f"[{WHITE_SPACE}]"))
        self._bytes = [b""] * (max(ranks.values()) + 1)
        for k, v in ranks.items():
            self._bytes[v] = k
        self._memo: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}

    @classmethod
    def from_file(cls, path: str, pattern: str) -> ByteBpe:
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        return cls({base64.b64decode(a): int(b) for a, b in pairs}, pattern)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token outside the vocabulary: lowest rank first, leftmost on ties."""
        n, ranks = len(piece), self._ranks
        end = list(range(1, n + 1))  # of the symbol that starts here; 0 once merged away
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if not mid or mid >= n or end[mid] != stop:
                continue
            end[i], end[mid] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def _piece(self, text: str) -> bytes:
        """A pre-token: by the perfect hash if the vocabulary has it whole, else by merges."""
        piece = text.encode()
        slot = self._mph.find(piece)
        got = self._rank_of_slot[slot] if slot >= 0 else b"".join([i.to_bytes(4, "little") for i in self.merge(piece)])
        if len(text) <= MEMO_CHARS and len(self._pieces) < MEMO_PIECES:
            self._pieces[text] = got
        return got

    def _segment(self, segment: str) -> bytes:
        known = self._pieces
        got = b"".join([known[m] if m in known else self._piece(m) for m in self._pattern.findall(segment)])
        if len(segment) <= MEMO_CHARS and len(self._memo) < MEMO_SEGMENTS:
            self._memo[segment] = got
        return got

    def encode_bytes(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        memo = self._memo
        first, *rest = _CUT.split(text) if _ODD_SPACE.search(text) else text.split(" ")
        out = [self._segment(first)]
        out += [memo[s] if s in memo else self._segment(s) for s in map(" ".__add__, rest)]
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self._bytes.__getitem__, ids))


@lru_cache(maxsize=4)
def coder(path: str | None = None, pattern: str | None = None) -> ByteBpe:
    """The worker's coder; by default of the public multilingual ranks."""
    import public_tokenizers

    return ByteBpe.from_file(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pattern or public_tokenizers.PATTERN)


def encode_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``id_col`` and ``ids`` (array<int>): the encoding of each row's whole text.

    A null text counts as empty (no ids), a null id stays null, repeated rows stay, other columns
    are not read. Map-only.
    """
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, ids array<int>"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        exclusive("byte BPE", coder.cache_clear)
        c = coder(ranks_path, pattern)
        flat = [c.encode_bytes(x or "") for x in batch.column(1).to_pylist()]
        ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in flat])]).astype(np.int32)
        values = np.frombuffer(b"".join(flat), dtype="<i4")
        return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], names=[id_col, "ids"])

    return map_arrow(df.select(F.col(id_col), F.col(text_col)), run, schema)


def decode_documents(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``id_col`` and ``decoded`` (binary): the bytes that each row's ids stand for; null ids give no bytes. Map-only."""
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, decoded binary"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        exclusive("byte BPE", coder.cache_clear)
        c = coder(ranks_path, pattern)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.decode(x or []) for x in batch.column(1).to_pylist()], type=pa.binary())], names=[id_col, "decoded"])

    return map_arrow(df.select(F.col(id_col), F.col(ids_col)), run, schema)


def round_trip_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encode, decode and digest in one pass: ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` per row.

    The same encoder and decoder as ``encode_documents`` and ``decode_documents``, fused so that
    no id leaves a worker. Nulls and repeated rows as there. Map-only.
    """
    schema = StructType([StructField(id_col, df.schema[id_col].dataType), StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        exclusive("byte BPE", coder.cache_clear)
        c = coder(ranks_path, pattern)
        n, ids_sha, text_sha = [], [], []
        for text in batch.column(1).to_pylist():
            raw = c.encode_bytes(text or "")
            n.append(len(raw) // 4)
            ids_sha.append(hashlib.sha256(raw).hexdigest())
            text_sha.append(hashlib.sha256(c.decode(np.frombuffer(raw, dtype="<u4").tolist())).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=schema.names)

    return map_arrow(df.select(F.col(id_col), F.col(text_col)), run, schema)
