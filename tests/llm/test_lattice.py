"""Lattice scores against every segmentation written out, and counts against a plain count."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import lattice

from .conftest import DDL, ROWS, prose

UNITS = sorted([b" a", b" ab", b" ", b"a", b"b", b"ab", b"ba", b"bab", b"c", b"abc"])


def segmentations(word):
    if not word:
        yield ()
    for unit, name in enumerate(UNITS):
        if word.startswith(name):
            yield from ((unit, *rest) for rest in segmentations(word[len(name) :]))


def all_words(most):
    return [b" " + "".join(x).encode() for n in range(most + 1) for x in itertools.product("abc", repeat=n)]


def test_forward_recursion_sums_all_segmentations():
    logs = np.log(np.random.default_rng(1).dirichlet(np.ones(len(UNITS)), size=2).T)
    words = all_words(6)
    got = lattice.Lattices(UNITS).log_likelihood(words, logs)
    for word, row in zip(words, got, strict=True):
        want = [math.log(sum(math.exp(sum(logs[u, k] for u in s)) for s in segmentations(word))) for k in range(2)]
        assert np.allclose(row, want)


def test_expected_counts_are_posterior_means():
    logs = np.log(np.random.default_rng(2).dirichlet(np.ones(len(UNITS))))
    words, times = all_words(5), np.arange(1.0, 1 + len(all_words(5)))
    want = np.zeros(len(UNITS))
    for word, n in zip(words, times, strict=True):
        each = [(s, math.exp(sum(logs[u] for u in s))) for s in segmentations(word)]
        for s, p in each:
            for u in s:
                want[u] += n * p / sum(q for _, q in each)
    assert np.allclose(lattice.Lattices(UNITS).expected(words, times, logs), want)


def test_word_probabilities_add_up_to_no_more_than_one():
    first = np.array([u[:1] == b" " for u in UNITS])
    rng = np.random.default_rng(3)
    model = lattice.LatticeModel.of_counts(rng.uniform(1, 5, (len(UNITS), 1)), np.array([9.0]), first)
    model.documents, model.class_documents, model.class_words, model.class_distinct = 2, [2], [10], [2]
    words = [w[1:] for w in all_words(7)]
    counts = np.array([[6.0 if w == b"ab" else 4.0 if w == b"c" else 0.0] for w in words])
    mass = (10 ** model.word_scores(lattice.Lattices(UNITS), words, counts)).sum() + 10 ** model.class_logs()[0][1]
    assert 0.95 < mass < 1  # the rest is on longer words


def test_a_round_does_not_lower_the_likelihood(spark):
    words = [(w, n) for w, n in Counter(prose(3, 3000).lower().split()).items()]
    df = spark.createDataFrame([(w, n, n) for w, n in words], "word string, n long, c0 long")
    lattices = lattice.Lattices(lattice.vocabulary()[0])
    spelled, times = [b" " + w.encode() for w, _ in words], np.array([n for _, n in words])
    seen = []
    for rounds in range(4):
        model = lattice.learn(df, [5], rounds=rounds)
        seen.append(float(times @ (lattices.log_likelihood(spelled, model.logs)[:, 0] + model.stop[0])))
    assert seen == sorted(seen) and seen[1] > seen[0]


def plain(rows):
    """held_out, n_tokens, n_known, train_tokens and base_score of each row, by a plain count."""
    bags = [Counter((t or "").encode().lower().split()) + Counter([None]) for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    count = sum((b for b, h in zip(bags, held, strict=True) if not h), Counter())
    n, v = count.total(), len(count)
    return [(h, b.total(), sum(k for w, k in b.items() if count[w]), n, round(sum(k * math.log10((count[w] + 1) / (n + v + 1)) for w, k in b.items()), 6)) for b, h in zip(bags, held, strict=True)]


def columns(df):
    return sorted((r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in df.collect())


@pytest.mark.parametrize("share", [lattice.HOT_SHARE, 0.05, 2.0])
def test_counts_and_base_scores(edge, monkeypatch, share):
    monkeypatch.setattr(lattice, "HOT_SHARE", share)
    got = lattice.score_documents(edge)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert columns(got) == sorted(plain([r[:2] for r in ROWS]))
    assert all(math.isfinite(r["score"]) and r["score"] <= 1e-9 for r in got.collect())


def test_scores_equal_a_slow_version(spark):
    rows = [(i, prose(i, 30) if i % 3 else prose(i, 30, "le la les une dans pour avec sur"), "en" if i % 3 else "fr", "a", 0) for i in range(1, 40)] + [(99, "unseen Wörter 1234", None, "a", 0), (100, "", "de", "a", 0)]
    df = spark.createDataFrame(rows, DDL)
    got = {r["doc_id"]: r["score"] for r in lattice.score_documents(df).collect()}
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2]
    order = [c for c, _ in Counter(r[2] for r in train if r[2]).most_common()]
    place = lambda lang: order.index(lang) if lang in order[: lattice.CLASSES] else len(order)
    bags = {k: sum((Counter(r[1].lower().split()) for r in train if place(r[2]) == k), Counter()) for k in sorted({place(r[2]) for r in train})}
    words = sorted(set().union(*bags.values()))
    docs = [sum(place(r[2]) == k for r in train) for k in bags]
    table = spark.createDataFrame([(w, 0, *(b[w] for b in bags.values())) for w in words], "word string, n long, " + ", ".join(f"c{k} long" for k in range(len(bags))))
    model = lattice.learn(table, docs)
    lattices = lattice.Lattices(lattice.vocabulary()[0])
    for r in rows:
        by_class = []
        for k, bag in enumerate(bags.values()):
            n = bag.total() + docs[k] + 1
            p = math.log(docs[k] / len(train)) + math.log(docs[k] / n)
            for w in r[1].lower().split():
                inner = float(lattices.log_likelihood([f" {w}".encode()], model.logs[:, k : k + 1])[0, 0]) + model.stop[k]
                p += math.log(max(bag[w] - lattice.DISCOUNT, 0) / n + (lattice.DISCOUNT * len(bag) + 1) / n * math.exp(inner))
            by_class.append(p)
        top = max(by_class)
        assert math.isclose(got[r[0]], (top + math.log(sum(math.exp(p - top) for p in by_class))) / math.log(10), rel_tol=1e-9, abs_tol=1e-9), r[0]


def test_a_very_long_word_and_texts_in_blocks(spark, monkeypatch):
    word = "".join(random.Random(4).choice("abcdeé") for _ in range(20_000))
    rows = [(1, word, "en", "a", 0), (2, f"the {word} of", "en", "a", 0), (3, "the of the", "en", "a", 0)]
    df = spark.createDataFrame(rows, DDL)
    whole = {r["doc_id"]: r["score"] for r in lattice.score_documents(df).collect()}
    monkeypatch.setattr(lattice, "LATTICE_BYTES", 64)
    assert {k: round(v, 6) for k, v in whole.items()} == {r["doc_id"]: round(r["score"], 6) for r in lattice.score_documents(df).collect()}


def test_edges(spark, nothing):
    assert lattice.score_documents(nothing).count() == 0
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    none = spark.createDataFrame([(i, "the of", "en", "a", 0) for i in held] + [(held[0], None, None, None, 0)], DDL)
    got = lattice.score_documents(none)
    assert columns(got) == sorted([(True, 3, 0, 0, 0.0)] * len(held) + [(True, 1, 0, 0, 0.0)])
    assert all(math.isfinite(r["score"]) for r in got.collect())
    empty = spark.createDataFrame([(1, "", "en", "a", 0), (3, None, "fr", "b", 0)], DDL)
    assert columns(lattice.score_documents(empty)) == [(False, 1, 1, 2, round(math.log10(3 / 4), 6))] * 2
    assert lattice.score_documents(empty.drop("lang")).count() == 2


def test_edges_of_empty_texts_by_who_trains(spark):
    """Of ids 1 and 3, the first is held out: one end is learned from; of 2 and 3, none is: two are."""
    assert [zlib.crc32(str(i).encode()) % 7 for i in (1, 2, 3)] == [2, 0, 6]
    for ids, held, n, base in [((1, 3), (False, True), 1, 2 / 3), ((2, 3), (False, False), 2, 3 / 4)]:
        empty = spark.createDataFrame([(ids[0], "", "en", "a", 0), (ids[1], None, "fr", "b", 0)], DDL)
        assert columns(lattice.score_documents(empty)) == [(h, 1, 1, n, round(math.log10(base), 6)) for h in held]


def test_held_out_text_is_likelier_than_under_the_counts(spark):
    df = spark.createDataFrame([(i, prose(i, 200), "en", "a", 0) for i in range(200)], DDL)
    got = lattice.score_documents(df).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got["s"] > got["b"]
