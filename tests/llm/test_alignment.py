"""Alignment against both libraries on whole texts and a count over all pairs."""

import hashlib
import random
from bisect import bisect_right
from collections import Counter, defaultdict
from itertools import accumulate, batched

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from strataflow.llm import alignment

from .conftest import DDL, ROWS, prose
from .test_tokenizers import FUZZ, SIGNS

R = random.Random(8)
TEXTS = FUZZ + ["".join(R.choice([*SIGNS, " word", " \n", "<unk>", "<0x41>"]) for _ in range(R.randrange(0, 20))) for _ in range(3000)]


@pytest.fixture(scope="module")
def slow():
    a, b = Tokenizer.from_file(P.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    a.encode_special_tokens = True
    known = alignment.Aligner(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))

    def run(text):
        """Tokens, groups and links of a whole text, by its cumulative ends."""
        if not text:
            return 0, 0, "", []
        x, y, want = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text), f" {text}".encode()
        xb, yb = [known._a_bytes[i] for i in x], [known._b_bytes[i] for i in y]
        if b"".join(xb) != want or b"".join(yb) != want:
            return 0, 0, "", []
        ends_x, ends_y = [*accumulate(map(len, xb))], [*accumulate(map(len, yb))]
        groups, links, low = [], [], 0
        for e in sorted({*ends_x} & {*ends_y}):
            one, two = (ids[bisect_right(ends, low) : bisect_right(ends, e)] for ids, ends in ((x, ends_x), (y, ends_y)))
            groups.append(f"{','.join(map(str, one))}|{','.join(map(str, two))}")
            links.append((one[-1], two[-1]))
            low = e
        return len(x), len(y), ";".join(groups), links

    return run


def want_of(slow, texts):
    done = [slow(t or "") for t in texts]
    count = Counter(p for *_, links in done for p in links)
    best_a, best_b = defaultdict(int), defaultdict(int)
    for (x, y), n in count.items():
        best_a[x], best_b[y] = max(best_a[x], n), max(best_b[y], n)
    return [
        (n_a, n_b, len(links), len(links), sum(count[p] == best_b[p[1]] for p in links), sum(count[p] == best_a[p[0]] for p in links), sum(count[p] for p in links), groups and hashlib.sha256(groups.encode()).hexdigest())
        for n_a, n_b, groups, links in done
    ]


@pytest.mark.parametrize("entries,block", [(alignment.MEMO_ENTRIES, alignment.BLOCK_CHARS), (40, 25)])
def test_aligner_equals_whole_text_encoding(slow, monkeypatch, entries, block):
    monkeypatch.setattr(alignment, "MEMO_ENTRIES", entries)
    monkeypatch.setattr(alignment, "BLOCK_CHARS", block)
    texts = [t for t in TEXTS if len(t) < 5000] if block < 100 else TEXTS
    aligner = alignment.Aligner(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    assert aligner.safe
    got = [x for part in batched(texts, 300) for x in aligner.documents(list(part))]
    for text, x in zip(texts, got, strict=True):
        n_a, n_b, groups, links = slow(text)
        assert (x.n_a, x.n_b, x.n_groups, x.groups_sha256) == (n_a, n_b, len(links), groups and hashlib.sha256(groups.encode()).hexdigest()), text[:80]
        assert dict(zip(x.pairs.tolist(), x.times.tolist(), strict=True)) == Counter(a << 32 | b for a, b in links)
    assert sum(not x.n_a for x in got) > 100  # the marker, and texts that are empty


@pytest.mark.parametrize("run", [1, 3, alignment.RUN_SEGMENTS])
def test_runs_of_segments_equal_single_ones(monkeypatch, run):
    monkeypatch.setattr(alignment, "RUN_SEGMENTS", run)
    aligner = alignment.Aligner(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    segments = sorted({s for t in TEXTS if len(t) < 5000 and alignment.SPACE not in t for s in alignment._CUT.split(t) if s and not s[-1].isspace()})
    done, groups, counts, links, rest = aligner._align_runs(segments)
    want = aligner._align_alone(done)
    assert done == segments and not rest
    assert groups == want[0] and (counts == want[1]).all() and (links == want[2]).all()
    assert aligner._align_runs([])[4] == []


def test_new_segments_are_not_aligned_one_by_one(monkeypatch):
    """What took most CPU seconds of the query: a merge in Python for each different segment."""
    aligner = alignment.Aligner(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    alone = []
    monkeypatch.setattr(aligner, "align_segment", lambda s, a, b: alone.append(s) or alignment.Aligner.align_segment(aligner, s, a, b))
    assert all(x.n_a for x in aligner.documents([prose(i, 500) for i in range(5)])) and not alone
    aligner.documents(["a ", "b\u2581c d"])
    assert sorted(alone) == ["", "b\u2581c"]


def test_a_segment_that_tokens_do_not_spell_leaves_others_alone():
    texts = [prose(i, 50, "river stone garden") for i in range(3)] + ["the beta of", "the market of beta", "market"]
    want = alignment.Aligner(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")).documents(texts)
    aligner = alignment.Aligner(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    for i in aligner._a.encode(" beta", add_special_tokens=False).ids:
        aligner._a_bytes[i] = b"?"
    got = aligner.documents(texts)
    assert all(x.n_a == 0 and not x.groups_sha256 and not len(x.pairs) for x in got[3:5])
    for x, y in zip([*got[:3], got[5]], [*want[:3], want[5]], strict=True):
        assert x[:4] == y[:4] and (x.pairs == y.pairs).all() and (x.times == y.times).all()


def test_merge_of_ends():
    assert alignment.merge_ends([1, 4, 6], [2, 4, 5, 6]) == [(2, 2), (3, 4)] and alignment.merge_ends([], []) == []


@pytest.mark.parametrize("share", [alignment.HOT_SHARE, 0.02, 2.0])
def test_counts_over_the_corpus(spark, edge, nothing, slow, monkeypatch, share):
    monkeypatch.setattr(alignment, "HOT_SHARE", share)
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "n_best_a", "count_sum", "groups_sha256")
    got = alignment.align_documents(edge)
    assert got.columns == ["doc_id", *columns]
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(want_of(slow, [r[1] for r in ROWS]))
    assert sorted(str(r["doc_id"]) for r in got.collect()) == sorted(str(r[0]) for r in ROWS)
    assert alignment.align_documents(nothing).count() == 0
    same = spark.createDataFrame([(1, prose(1, 30), "en", "a", 0)] * 40 + [(2, None, None, None, 0)], DDL)
    assert sorted(tuple(r[c] for c in columns) for r in alignment.align_documents(same).collect()) == sorted(want_of(slow, [prose(1, 30)] * 40 + [None]))
