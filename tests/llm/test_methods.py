"""Each method against a slow version of itself, and the cases that its bounds are about."""

import hashlib
import itertools
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import fingerprints, html_extract, language_id, packing, quality_classifier, quality_rules, simhash, substring_dedup

from .conftest import DDL, prose


def docs(spark, *rows):
    return spark.createDataFrame([(*r[:2], "en", r[2] if len(r) > 2 else "s", 0) for r in rows], DDL)


def test_a_repeated_row_is_one_document_to_the_line_count(spark):
    line = "this very line is boiler plate"
    rows = [(1, f"{line}\n{prose(1, 40)}")] * 9 + [(i, f"{line}\n{prose(i, 40)}", "t") for i in range(2, 8)] + [(None, f"{line}\n{prose(i, 40)}", "u") for i in range(6)]
    got = quality_rules.quality_rules(docs(spark, *rows), line_documents=4).collect()
    assert {(r["n_words"] - r["n_words_left"], r["doc_id"] is None, r["doc_id"] == 1) for r in got} == {(0, False, True), (6, False, False), (6, True, False)}


# --- quality classifier


def slow_pool(model, text):
    words = quality_classifier._WORD.findall(text)
    if not words:
        return np.zeros(quality_classifier.WIDTH)
    v = [model.word_vectors([w])[0].astype(float) for w in words]
    mean = sum(v) / len(v)
    return np.array([*mean, *np.sqrt(sum((x - mean) ** 2 for x in v) / len(v))])


@pytest.fixture(scope="module")
def quality_rows():
    good = [(prose(i, 40 + i % 90), 1) for i in range(240)]
    shout = [(" ".join(w.upper() + "!!" for w in prose(2000 + i, 60).split()), 0) for i in range(80)]
    stutter = [(" ".join(w for w in prose(3000 + i, 12).split() for _ in range(6)), 0) for i in range(80)]
    marks = [(" ".join(w + random.Random(j).choice(("%%%", "$$$", "###")) for j, w in enumerate(prose(4000 + i, 60).split())), 0) for i in range(80)]
    return [x for four in itertools.zip_longest(good, shout, stutter, marks) for x in four if x]


def test_quality_pooling_and_network_equal_a_slow_version(quality_rows, monkeypatch):
    model = quality_classifier.fit(*zip(*quality_rows, strict=True))
    texts = [t for t, _ in quality_rows[:30]] + ["", "x", "!!! !!!!!!", prose(9, 900), "über Ünder 12 3a_b __"]
    want = np.array([slow_pool(model, t) for t in texts])
    for block in (quality_classifier.BLOCK, 7):
        monkeypatch.setattr(quality_classifier, "BLOCK", block)
        assert np.allclose(model.pooled(texts), want, atol=1e-4)
    hidden = [[np.tanh(sum((x[i] - model.mean[i]) / model.scale[i] * model.w1[i, j] for i in range(len(x))) + model.b1[j]) for j in range(model.w1.shape[1])] for x in want]
    slow = [1 / (1 + np.exp(-(sum(h * w for h, w in zip(hs, model.w2, strict=True)) + model.b2) / model.temperature)) for hs in hidden]
    assert np.allclose(model.score(texts), slow, atol=1e-3)


def test_the_network_sees_pooled_vectors_alone(quality_rows):
    """Mean and spread of word vectors: a text's words in any order, or all of them twice, are scored alike."""
    model = quality_classifier.fit(*zip(*quality_rows, strict=True))
    assert quality_classifier.WIDTH == 2 * quality_classifier.DIM == len(model.w1)
    words = quality_rows[1][0].split()
    shuffled = random.Random(2).sample(words, len(words))
    assert np.allclose(model.score([" ".join(words)]), model.score([" ".join(shuffled), " ".join(words + words)]), atol=1e-4)


def test_temperature_has_no_bound():
    rng = np.random.default_rng(0)
    chance = rng.uniform(0.02, 0.98, 4000)
    y = (rng.uniform(size=4000) < chance).astype(float)
    logit = np.log(chance / (1 - chance))
    for scale in (0.001, 0.05, 1.0, 30.0, 5000.0):
        assert quality_classifier.temperature(logit * scale, y) == pytest.approx(scale, rel=0.1)
    parted = quality_classifier.temperature(np.array([-2.0, -1.0, 1.0, 2.0]), np.array([0.0, 0.0, 1.0, 1.0]))
    assert 0 < parted < 10 and quality_classifier.temperature(-logit, y) == 1.0


def test_the_labelled_sample_is_bounded_whatever_repeats(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(900)], "doc_id long, quality int, toxic int").repartition(40)
    df = docs(spark, *[(i, f"text {i}") for i in range(900)], *[(8, f"another {k}") for k in range(300)])
    got = quality_classifier.training_sample(df, labels, max_rows=100).collect()
    assert len(got) == 100 and {r["y"] for r in got} == {0, 1}


def test_quality_scores_of_rows_not_learned_from(quality_rows):
    held = quality_rows[::5]
    model = quality_classifier.fit(*zip(*[r for i, r in enumerate(quality_rows) if i % 5], strict=True))
    score = model.score([t for t, _ in held])
    pairs = [(a, b) for a, (_, x) in zip(score, held, strict=True) for b, (_, y) in zip(score, held, strict=True) if x > y]
    assert np.mean([a > b for a, b in pairs]) > 0.95


def test_quality_words_are_whole_and_unseen_ones_have_vectors(quality_rows):
    model = quality_classifier.fit(*zip(*quality_rows, strict=True))
    v = model.word_vectors(["!!!", "!!!!!!", "neverseen", "Neverseen", "NEVERSEEN", "the"])
    assert np.allclose(np.linalg.norm(v, axis=1), 1, atol=1e-3) and len({x.tobytes() for x in v}) == 6


def test_quality_labels_that_contradict_each_other_are_not_learned(spark):
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (2, 1, 0), (2, 1, 0), (3, 7, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    df = docs(spark, (1, "a"), (2, "b"), (3, "c"), (None, "d"))
    want = {2} - {i for i in (1, 2, 3) if zlib.crc32(str(i).encode()) % 5 == 0}  # one of each id
    assert [(r["t"], r["y"]) for r in quality_classifier.training_sample(df, labels).collect()] == [("b", 1) for _ in want]


# --- language


def grams(text):
    """Presence set by plain loops: places of the hashed n-grams of lower-cased letters, other runs being one space."""
    codes, out = [0], set()
    for ch in text.lower():
        c = ord(ch) if ch.isalpha() else 0
        if c or codes[-1]:
            codes.append(c)
    if codes[-1]:
        codes.append(0)
    for n in language_id.GRAMS:
        for i in range(len(codes) - n + 1):
            h = n * 0x9E3779B1 & 0xFFFFFFFF
            for c in codes[i : i + n]:
                h = (h ^ c) * 0x85EBCA6B & 0xFFFFFFFF
                h ^= h >> 13
            out.add(h >> (32 - language_id.BITS))
    return out


def test_presence_is_that_of_all_n_grams():
    for t in ("Hello, World", "a", " é--É ", prose(1, 300), "ß1ü22ö", "x y z " * 50):
        assert set(language_id.presence(t).tolist()) == grams(t)
    assert language_id.presence("12 .. !") is None


def language(i, seed, n=60):
    r = random.Random(i)
    syllables = ["".join(r.choice("bcdfghjklmnprstvz") + r.choice("aeiouyäöüé") for _ in range(2)) for _ in range(12)]
    r = random.Random(seed)
    return " ".join(r.choice(syllables) + r.choice(syllables) for _ in range(n))


def test_no_language_is_left_out_however_many(spark):
    rows = [(7 * k + j, language(k, 100 * k + j), f"l{k:03d}", "s", 0) for k in range(230) for j in range(4)]
    df = spark.createDataFrame(rows, DDL)
    sample = language_id.training_sample(df, F.lit(True), max_rows=460)
    assert sample.select("l").distinct().count() == 230
    model = language_id.fit(*zip(*[(t, lang) for _, t, lang, _, _ in rows[:120]], strict=True))
    got, _ = model.predict([language(k, 90_000 + k) for k in range(30)])
    assert sum(x == f"l{k:03d}" for k, x in enumerate(got)) >= 28


def test_a_score_is_the_mean_of_equal_blocks_whatever_the_length():
    model = language_id.fit(*zip(*[(language(k, 100 * k + j, 300), f"l{k}") for k in range(4) for j in range(40)], strict=True))
    r = random.Random(1)
    for n in (1, 700, 1000, 5000, 90_000):
        text = " ".join(language(2, r.random(), 300) for _ in range(n // 300 + 1))[: n * 6]
        blocks = language_id.text_blocks(text)
        assert max(map(len, blocks)) <= language_id.BLOCK_CHARS + 2 * (max(language_id.GRAMS) - 1) and len(blocks) == -(-len(text) // language_id.BLOCK_CHARS)
        grams_ = [language_id.presence(b) for b in blocks]
        want = np.mean([model.margins([g])[0] for g in grams_ if g is not None], axis=0)
        (lang,), (score,) = model.predict([text])
        assert lang == model.languages[int(want.argmax())] and abs(score - min(1, max(0, (want.max() + 1) / 2))) < 1e-5
        assert set().union(*({*g.tolist()} for g in grams_)) >= {*language_id.presence(text).tolist()} - {*language_id.presence(" ").tolist()} if language_id.presence(" ") is not None else True
        assert lang == "l2" or n == 1


def test_a_language_s_sample_is_cut_by_hash_not_by_task(spark):
    """Rows that meet do not grow with partitions: 5,000 of them send no more than a bounded share each."""
    df = spark.range(0, 40_000, 1, 400).select(F.col("id").alias("doc_id"), F.concat(F.lit("word number "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    cut = language_id.candidates(df, F.lit(True), per_language=50)
    assert 50 <= cut.count() <= 400
    same = language_id.candidates(df.withColumn("doc_id", F.lit(1).cast("long")).withColumn("text", F.lit("one text")), F.lit(True), per_language=50)
    assert same.count() == 1
    got = language_id.training_sample(df, F.lit(True), per_language=50)
    assert got.count() == 50 and sorted(map(tuple, got.collect())) == sorted(map(tuple, language_id.training_sample(df.repartition(3), F.lit(True), per_language=50).collect()))


# --- packing


def test_rows_of_one_id_do_not_fill_a_group(spark):
    df = spark.range(40_000, numPartitions=4).select(F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("id")).alias("doc_id"), F.lit(0).alias("piece"), (F.col("id") % 700 + 1).cast("long").alias("length"))
    got = packing.pack(df, group_pieces=2000)
    sizes = [r["count"] for r in got.filter("sequence_id < 0").groupBy(F.expr("shiftright(-1 - sequence_id, 32)")).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 2500


@pytest.mark.parametrize("competes", [False, True])
def test_sum_of_squares_equals_a_slow_version(competes):
    rng = random.Random(4)
    lengths, capacity = [rng.randrange(1, 31) for _ in range(300)], 30
    gaps, want = [], []
    for s in lengths:
        choices = [(sum(n * n for g, n in zip(*np.unique([x for j, x in enumerate([*gaps[:i], gaps[i] - s, *gaps[i + 1 :]]) if 0 < x < capacity], return_counts=True), strict=True)), gaps[i], i) for i in range(len(gaps)) if gaps[i] >= s]
        new = (sum(n * n for g, n in zip(*np.unique([x for x in [*gaps, capacity - s] if 0 < x < capacity], return_counts=True), strict=True)), capacity, -1)
        best = min(choices, default=None, key=lambda c: c[:2])
        if best is None or competes and s < capacity and new[0] < best[0]:
            gaps.append(capacity - s)
            want.append(capacity)
        else:
            gaps[best[2]] -= s
            want.append(best[1])
    bins, offsets = packing.sum_of_squares(np.array(lengths), capacity, competes)
    assert [capacity - x for x in offsets.tolist()] == want and len(set(bins.tolist())) == len(gaps)


# --- fingerprints


def test_neighbours_equal_brute_force_whatever_the_ids(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, None, 7, i]), prose(rng.randrange(30), 30) if i % 9 else None) for i in range(400)] + [(7, "same text. of all")] * 300
    order = sorted(((-(1 << 63) if i is None else i), t or "") for i, t in rows)
    for df in (docs(spark, *rows), docs(spark, *rows).withColumn("doc_id", F.col("doc_id").cast("string"))):
        got = fingerprints.compare_with_next(df).collect()
        assert len(got) == len(rows)
        by_id = {}
        for r in got:
            by_id.setdefault(r["doc_id"], []).append(r)
        assert sorted((str(k), len(v)) for k, v in by_id.items()) == sorted((str(k) if k is not None else "None", sum(x == k for x, _ in rows)) for k in {x for x, _ in rows})
    got = fingerprints.compare_with_next(docs(spark, *rows)).collect()
    texts = {}
    for i, t in order:
        texts.setdefault(i, []).append(t)
    distinct = sorted(texts)
    for n, i in enumerate(distinct):  # any text of the id may be next to any other of it, or the last to one of the next id
        following = set(texts[i]) | set(texts[distinct[(n + 1) % len(distinct)]])
        allowed = {hashlib.sha256((a[: len(a) - len(a) // 4] + b[: len(a) // 4]).encode()).hexdigest() for a in texts[i] for b in following}
        assert all(r["edited_sha256"] in allowed for r in got if (r["doc_id"] if r["doc_id"] is not None else -(1 << 63)) == i)


def test_rows_of_one_id_take_several_ranges(spark):
    rows = [(None if i % 4 else i, "one text" if i % 2 else prose(i, 12)) for i in range(4000)]
    sizes = [r["count"] for r in fingerprints.ordered_neighbours(docs(spark, *rows).repartition(4), "doc_id", "text", 8).groupBy("range").count().collect()]
    assert sum(sizes) <= 4000 + 8 * 4 and max(sizes) < 1200


def test_first_rows_are_kept_whatever_columns_are_named(spark):
    rows = [(1, "one two three four"), (2, "one two three four"), (3, "other words are here now"), (3, "completely different text of five"), (None, "one two three four"), (None, "lonely words without an id"), (None, None)]
    df = spark.createDataFrame([(*r, *"abcdefghijk") for r in rows], "doc_id long, text string, stays string, __id string, id string, own string, key string, tie string, row string, n string, fp string, component_id string, fingerprint string")
    got = simhash.keep_first(df.repartition(3))
    assert got.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "", r["stays"], r["fingerprint"]) for r in got.collect() if r["doc_id"] != 3) == [(0, "", "a", "k"), (0, "lonely words without an id", "a", "k"), (1, "one two three four", "a", "k")]
    first = {tuple(r["text"] for r in simhash.keep_first(df.repartition(n)).filter("doc_id = 3").collect()) for n in (1, 2, 5)}
    assert len(first) == 1 and len(next(iter(first))) == 1


# --- html

SHARED = ["Site menu", "All about us", "Sign up now", "Same words each day"]


def test_differencing_decides_where_no_element_marks_the_text(spark):
    def page(i):
        own = [f"Line {i} {k} of its own" for k in range(3)]
        return "<body>" + "".join(f"<div>{x}</div>" for x in [SHARED[0], own[0], SHARED[1], own[1], own[2], *SHARED[2:]]) + "</body>", "\n".join(own)

    rows = [(i, f"https://host{i % 3}.example/a/{i:03d}", page(i)[0]) for i in range(60)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: page(i)[1] for i in range(60)}


def test_pairs_are_those_of_a_search_of_all_pages(spark):
    rng = random.Random(3)
    rows = []
    for i in range(150):
        lines = rng.sample(["aa", "bb", "cc", "dd", "ee", "ff", "gg"], rng.randrange(1, 5))
        rows.append((i, f"http://h{rng.randrange(3)}.example/{rng.choice('xyz')}{rng.randrange(40):02d}/{i}", "".join(f"<div>{x}</div>" for x in lines), lines))
    want = {}
    for i, url, _, lines in rows:
        host, path = url[7:].split("/", 1)
        own = sorted((u[7:].split("/", 1)[1], j, x) for j, u, _, x in rows if u[7:].split("/", 1)[0] == host)
        at = [j for _, j, _ in own].index(i)
        sides = [next(((p, x) for p, _, x in side if x != lines), None) for side in (own[:at][::-1], own[at + 1 :])]
        common = lambda p: len(p) if path.startswith(p) else next(k for k, (a, b) in enumerate(zip(path, p, strict=False)) if a != b)  # noqa: B023, E731
        near = max((s for s in sides if s), key=lambda s: common(s[0]), default=None)
        want[i] = "\n".join(x for x in lines if near is None or x not in near[1] or not kept_out(lines, near[1], x))
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").repartition(4)).collect()}
    assert sum(got[i] == want[i] for i in want) == len(want)


def kept_out(a, b, line):
    """Whether the subsequence that ``common_lines`` chooses takes the line away."""
    ids = {x: n for n, x in enumerate(sorted({*a, *b}))}
    return a.index(line) in html_extract.common_lines([ids[x] for x in a], [ids[x] for x in b])


def test_equal_rows_take_several_ranges(spark):
    """A page that comes thousands of times fills no task, and has the same partner everywhere."""
    body = "<div>menu</div><div>text</div>"
    rows = [(1, "http://h/a", body)] * 3000 + [(0, "http://h/0", "<div>menu</div><div>other</div>"), (2, "http://h/b", "<div>menu</div><div>third</div>")]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7))
    assert {(r["page_id"], r["text"]): r["count"] for r in got.groupBy("page_id", "text").count().collect()} == {(0, "other"): 1, (1, "text"): 3000, (2, "third"): 1}


def test_odd_pages_take_linear_time():
    for unit in ('<a "', '<a "> " ', "<script ", "<a '\"> ", "<!", "<!--", "</x", "<p>", "<b>", "<svg>"):
        html_extract.page_lines(unit * 20_000)
    for attribute in ("a" * 300_000, "a-" * 150_000, "class=" * 50_000, "a=" + " " * 300_000, "x='" * 100_000, " " * 300_000):
        began = time.process_time()
        html_extract.page_lines(f"<div {attribute}>text</div>")
        assert time.process_time() - began < 2, attribute[:10]
    assert html_extract.page_lines('<div 1class="menu" data-x hidden>a</div><div x-y = \'q\' class = "nav">b</div><p id=main>c</p>') == [("a", html_extract.JUNK), ("b", html_extract.JUNK), ("c", html_extract.PLAIN)]
    n = 8000
    assert len(html_extract.common_lines([1] * n, [2] + [1] * (n - 5))) == n - 5


# --- substring dedup


@pytest.mark.parametrize("hard", [substring_dedup.HARD_BAND, 0])
def test_near_lines_connect_what_brute_force_connects(spark, monkeypatch, hard):
    monkeypatch.setattr(substring_dedup, "HARD_BAND", hard)
    rng = random.Random(8)
    own = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    lines = []
    for _ in range(24):  # families of edited copies: some near each other, some only by way of others
        base = own(rng.randrange(30, 200))
        lines += [" ".join(base)]
        for _ in range(rng.randrange(2, 14)):
            copy = list(base if rng.random() < 0.7 else lines[-1].split())
            for _ in range(rng.randrange(1, 4)):
                copy[rng.randrange(len(copy))] = own(1)[0]
            lines.append(" ".join(copy))
    lines += [" ".join(own(30)) for _ in range(20)]
    rows = [(i, x) for i, x in enumerate(lines)]
    shingles = [{" ".join(x.split()[k : k + 5]) for k in range(len(x.split()) - 4)} for x in lines]
    similar = {(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines)) if len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j])}

    def closure(pairs):
        low = list(range(len(lines)))
        while True:
            new = list(low)
            for i, j in pairs:
                new[i] = new[j] = min(new[i], new[j])
            if new == low:
                return low
            low = new

    df = docs(spark, *rows)
    table = substring_dedup.passage_table(df, "doc_id", "text", substring_dedup.tune_bands(), substring_dedup.ROWS).cache()
    place = {r["h"]: r["doc"] for r in table.filter("kind = 2").collect()}
    members = substring_dedup.band_members(table)
    full = spark.sparkContext.broadcast(np.full(1 << 19, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64))  # a bitmap that lets all pass
    sets = substring_dedup.details(df, "doc_id", "text", full, full, full).filter("kind = 4")
    links = {tuple(sorted((place[r["a"]], place[r["b"]]))) for r in substring_dedup.near_lines(members, sets, 0.8).collect()}
    assert links <= similar and len(links) < len(similar)
    want, got = closure(similar), closure(links)
    assert len(similar) > 150 and np.mean([a == b for a, b in zip(want, got, strict=True)]) >= 0.95


def test_a_band_of_lines_that_are_unlike_makes_no_square_of_pairs(spark):
    """Many different lines in one band, some of them edited copies: all near pairs are found, and few others leave the join."""
    rng = random.Random(4)
    common = [rng.randrange(1 << 62) for _ in range(12)]  # what brings them into the band
    lines: list[set] = []
    for n in range(700):
        lines.append({*common, *(rng.randrange(1 << 62) for _ in range(28))} if n % 7 else {*sorted(lines[-1])[2:], rng.randrange(1 << 62)} if lines else {*common})
    near = {(i, j) for i in range(len(lines)) for j in range(i) if len(lines[i] & lines[j]) >= 0.8 * len(lines[i] | lines[j])}
    rows = []
    for n, x in enumerate(lines):
        flat = np.array(sorted(x), dtype=np.uint64)
        rows.append((n, n, len(x), [int(v) for v in sorted(x)], *(int(w[0]) for w in substring_dedup._sketches(flat, np.array([0])))))
    df = spark.createDataFrame(rows, "h long, label long, size int, shingles array<long>, " + ", ".join(f"{c} long" for c in substring_dedup.SKETCH))
    pairs = substring_dedup.sharing_rare_shingles(df.drop("shingles"), df.drop("label"), 0.8).distinct()
    got = {(max(r["a"], r["b"]), min(r["a"], r["b"])) for r in pairs.collect()}
    assert len(near) > 60 and near <= got and len(got) < 10 * len(lines)
    assert {(max(r["a"], r["b"]), min(r["a"], r["b"])) for r in substring_dedup.similar(pairs, df.drop("label"), 0.8).collect()} == near


def test_ids_that_are_no_numbers_and_rows_without_id(spark):
    p = prose(5, 70)
    df = spark.createDataFrame([("b", f"{prose(1, 30)} {p}"), ("a", f"{prose(2, 30)} {p}"), (None, f"{p} {prose(3, 30)}"), (None, f"{p} {prose(3, 30)}"), ("c", None)], "doc_id string, text string")
    got = {(r["doc_id"], r["text"] is None): r for r in substring_dedup.dedup_substrings(df).collect()}
    assert not got[None, False]["changed"] and got["a", False]["changed"] and got["b", False]["changed"] and got["c", True]["text"] is None
    assert p[:-1] not in got["a", False]["text"]


def test_one_of_each_group_stays_with_repeated_rows(spark):
    a, b = prose(1, 50), prose(2, 50)
    rows = [(3, a), (1, a), (1, a), (2, a + " x"), (9, b), (9, b), (None, a), (None, prose(4, 50)), (8, None), (7, "")]
    kept = [(r["doc_id"], r["text"]) for r in simhash.keep_first(docs(spark, *rows)).collect()]
    near = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs(spark, *rows)).collect()}
    assert sorted(str(k[0]) for k in kept) == sorted(["1", "9", "None", "7"] + (["2"] if near[2] == 2 else []))


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_components_by_one_task_and_by_rounds(spark, few):
    from strataflow.llm.components import connected_components

    rng = random.Random(few)
    pairs = [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(200 + i, 201 + i) for i in range(30)] + [(7, 7), (None, 3), (3, None)]
    low = {x: x for p in pairs if None not in p and p[0] != p[1] for x in p}
    for _ in range(40):
        for a, b in pairs:
            if a in low and b in low:
                low[a] = low[b] = min(low[a], low[b])
    got = connected_components(spark.createDataFrame(pairs, "a long, b long"), few_edges=few)
    assert sorted(tuple(r) for r in got.collect()) == sorted(low.items())
    assert connected_components(spark.createDataFrame([], "a long, b long"), few_edges=few).count() == 0
