import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from strataflow.llm import byte_bpe, packing, token_counts

from .conftest import ROWS, prose

SIGNS = ["a", "b", " ", "  ", "\n", "\t", "é", "▁", "the", "The", "don't", "ÉA", "<s>", "<|endoftext|>", "你好", "'s", "12", "　", "\x00", "\x1c", "😀", ".", "\xa0", "\x85", " ", "́", "ſ", "İ", "ß", "ª", "²", "Σ", " ", "­", "'"]
R = random.Random(5)
FUZZ = ["".join(R.choice(SIGNS) for _ in range(R.randrange(0, 14))) for _ in range(1500)] + [r[1] or "" for r in ROWS] + [prose(9, 500)]


@pytest.fixture(scope="module")
def rank_library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_are_the_library_s():
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    counter = token_counts.SegmentCounter(P.path("piece_bpe_32k.model"))
    assert counter.safe and counter.count(FUZZ) == [len(sp.encode(t)) for t in FUZZ]


def test_counts_on_edges(spark, edge, nothing):
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = sorted((r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.token_counts(edge).collect())
    want = [(len((t or "").encode()), len(sp.encode(t or ""))) for _, t, *_ in ROWS]
    assert got == sorted((a, b, b > 4096) for a, b in want)
    assert token_counts.token_counts(nothing).count() == 0


def test_byte_bpe_is_the_library_s(rank_library):
    coder = byte_bpe.coder()
    for t in FUZZ:
        ids = coder.encode(t)
        assert ids == rank_library.encode_ordinary(t) and coder.decode(ids) == t.encode()


def test_perfect_hash_is_minimal_and_rejects_others():
    keys = [f"k{i}".encode() for i in range(3000)]
    mph = byte_bpe.MinimalPerfectHash(keys)
    assert sorted(mph.find(k) for k in keys) == list(range(3000)) and all(mph.find(f"x{i}".encode()) == -1 for i in range(3000))


def test_byte_bpe_on_edges(edge, nothing, rank_library):
    got = sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in byte_bpe.round_trip_digests(edge).collect())
    want = [(ids := rank_library.encode_ordinary(t or ""), hashlib.sha256((t or "").encode()).hexdigest()) for _, t, *_ in ROWS]
    assert got == sorted((len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), h) for i, h in want)
    back = byte_bpe.decode_documents(byte_bpe.encode_documents(edge.filter("doc_id is not null").dropDuplicates(["doc_id"])))
    texts = {r[0]: r[1] for r in ROWS}
    assert all(bytes(r["decoded"]) == (texts[r["doc_id"]] or "").encode() for r in back.collect())
    assert byte_bpe.round_trip_digests(nothing).count() == 0 == byte_bpe.encode_documents(nothing).count()


def test_word_tokenizer_is_the_library_s():
    library, own = Tokenizer.from_file(P.path("word_bpe_49k.json")), packing.WordTokenizer(P.path("word_bpe_49k.json"))
    for t in FUZZ:
        assert np.frombuffer(own.encode_bytes(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, ascii(t[:80])


def check_packing(rows, capacity):
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_on_edges(edge, nothing):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = packing.pack_documents(edge).collect()
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t, *_ in ROWS if i is not None}
    for i, want in ids.items():
        mine = sorted({(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == i})
        assert mine == [(k, a, len(want[a : a + 2048]), zlib.crc32(np.array(want[a : a + 2048], "<u4").tobytes())) for k, a in enumerate(range(0, len(want), 2048))]
    total = sum(r["length"] for r in rows)
    assert check_packing(rows, 2048) <= -(-total // 2048) + 1
    assert packing.pack_documents(nothing).count() == 0


@pytest.mark.parametrize("groups", [50, 4096])
def test_packing_is_near_the_bound(spark, groups):
    lengths = [random.Random(i).choice([3, 40, 700, 900, 1100, 1500, 2048, 2047]) for i in range(600)]
    df = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length long").selectExpr("doc_id", "0 piece", "length", "'x' sequence_id")
    rows = packing.pack(df, group_pieces=groups).collect()
    gaps: list[int] = []
    for s in sorted(lengths, reverse=True):  # best fit decreasing, of all rows at once
        fit = min((g for g in gaps if g >= s), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((2048 if fit is None else fit) - s)
    assert len(rows) == 600 and check_packing(rows, 2048) <= len(gaps) + 600 / groups + 1


def test_sum_of_squares_matches_its_definition():
    lengths, capacity = [random.Random(i).randrange(1, 20) for i in range(200)], 20
    bins, offsets = packing.sum_of_squares(np.array(lengths), capacity)
    used: list[int] = []
    for s, b, o in zip(lengths, bins, offsets, strict=True):
        gaps = [capacity - u for u in used]
        scores = {}
        for g in sorted({g for g in gaps if g >= s}):
            after = [*gaps[: gaps.index(g)], g - s, *gaps[gaps.index(g) + 1 :]]
            scores[g] = sum(after.count(x) ** 2 for x in set(after) if 0 < x < capacity)
        assert b == len(used) if not scores else scores[capacity - used[b]] == min(scores.values())
        if b == len(used):
            used.append(0)
        assert used[b] == o
        used[b] += s
