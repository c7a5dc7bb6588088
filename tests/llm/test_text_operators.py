import hashlib
import re

import duckdb
import numpy as np
import pytest
import xxhash

from strataflow.llm import fingerprints, html_extract, language_id, quality_classifier, quality_rules, simhash, substring_dedup
from strataflow.llm.components import connected_components

from .conftest import DDL, ROWS, prose


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DDL)


@pytest.mark.parametrize("limit", [2, 1000])
def test_quality_rules_equal_their_sql(spark, nothing, limit):
    rows = [(i % 40 if i % 9 else None, ["A\nb b\n\nfoo 12 bar", "A\n foo  99 bar\nthe quick brown fox jumps over the lazy dog once\nx", None, "", "b  b\nw1 w2 w3 w4 w5 w6 w1 w2 w3 w4 w5 z w1 w2 w3 w4 w5"][i % 5], f"s{i % 3}" if i % 7 else None) for i in range(60)]
    rows += [(i, t, s) for i, t, _, s in ROWS if i not in (8, 9)]
    df = docs(spark, *rows).selectExpr("*", "1 as kept", "2 as host", "3 as d", "4 as i", "5 as line")
    got = quality_rules.quality_rules(df, line_documents=limit)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_words_left", "kept"]
    c = duckdb.connect()
    c.execute("create table documents(doc_id bigint, text varchar, source varchar)")
    c.executemany("insert into documents values (?, ?, ?)", rows)
    want = c.execute(quality_rules.ORACLE_SQL.replace(f"> {quality_rules.LINE_DOCUMENTS})", f"> {limit})")).fetchall()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=key) == sorted(want, key=key)
    assert quality_rules.quality_rules(nothing).count() == 0


def test_frequent_lines_are_removed_and_depleted_rows_rejected(spark):
    rows = [(i, f"Boilerplate  Line {i}\n{prose(i, 40)}", "h") for i in range(6)] + [(9, "boilerplate line 7\nboilerplate line 8\n" + " ".join(f"q{i}" for i in range(12)), "h"), (10, "Boilerplate line 1\n" + prose(77, 40), "other")]
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs(spark, *rows), line_documents=4, least_left=70).collect()}
    assert got[3]["text"] == prose(3, 40) and got[3]["kept"] and got[10]["text"].startswith("Boilerplate")
    assert not got[9]["kept"] and not got[9]["base_failed"] and got[9]["n_words_left"] == 12


def test_long_text_repeat_words_are_linear(spark):
    text = " ".join(["a b c d e f g"] * 30_000)
    r = quality_rules.quality_rules(docs(spark, (1, text, "s"))).first()
    assert r["n_repeat_words"] == r["n_words"] == 210_000


LANGS = {"en": "the of and to in that with river stone garden", "de": "der die und zu in das mit fluss stein garten", "fr": "le la et de dans que avec fleuve pierre jardin"}


def language_rows(n):
    return [(i, " ".join(prose(i, 30, LANGS[lang]).replace(f"w{i}x", "").split()), lang, "s", 0) for i, lang in enumerate(list(LANGS) * n)]


def test_language_id(spark, edge, nothing):
    df = spark.createDataFrame(language_rows(60), DDL)
    model = language_id.learn(df)
    assert model.languages == ["de", "en", "fr"]
    truth = {r[0]: r[2] for r in language_rows(60)}
    got = language_id.identify(df, model).select("doc_id", language_id.held_out("doc_id").alias("o"), "lang_pred", "score").collect()
    held = [r for r in got if r["o"]]
    assert held and sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.95 * len(held) and all(0 <= r["score"] <= 1 for r in got)
    import zlib

    assert all(r["o"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    on_edge = language_id.identify(edge, model).collect()
    assert len(on_edge) == len(ROWS) and {r["lang_pred"] for r in on_edge if r["doc_id"] in (4, 5, 6, 10)} == {"und"}
    assert language_id.identify(nothing, model).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(edge, language_id.learn(nothing)).collect()} == {"und"}
    kept = language_id.keep_identified(edge, model)
    assert kept.columns == edge.columns and not {4, 5, 6, 10} & {r["doc_id"] for r in kept.collect()}


def test_kernel_margins_are_those_of_the_definition():
    texts, langs = zip(*[(r[1], r[2]) for r in language_rows(6)], strict=True)
    model = language_id.fit(list(texts), list(langs), landmarks_per_language=4)
    g = language_id.presence(texts[0])
    k = np.array([len(np.intersect1d(g, np.flatnonzero(model.landmarks[:, j]))) / np.sqrt(len(g) * np.count_nonzero(model.landmarks[:, j])) for j in range(model.landmarks.shape[1])])
    assert np.allclose(model.margins([g])[0], k @ model.weights, atol=1e-4)


def test_quality_classifier(spark, edge, nothing):
    rows = [(i, prose(i, 60) if i % 3 else " ".join(w.upper() + "!!" for w in prose(i, 60).split()), "s") for i in range(240)]
    labels = spark.createDataFrame([(i, int(bool(i % 3)), 0) for i in range(240)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    df = docs(spark, *rows)
    model = quality_classifier.learn(df, labels)
    again = quality_classifier.learn(df.repartition(5), labels)
    assert np.allclose(model.w1, again.w1)
    got = quality_classifier.classify(df, model).select("doc_id", quality_classifier.held_out("doc_id").alias("o"), "score", "predicted").collect()
    held = [r for r in got if r["o"]]
    assert held and all(r["predicted"] == int(bool(r["doc_id"] % 3)) for r in held) and all((r["score"] >= 0.3) == bool(r["predicted"]) for r in got)
    assert quality_classifier.classify(edge, model).count() == len(ROWS) and quality_classifier.classify(nothing, model).count() == 0
    blank = quality_classifier.learn(nothing, labels)
    assert {r["score"] for r in quality_classifier.classify(edge, blank).collect()} == {0.5}
    kept = quality_classifier.keep_good(edge, model)
    assert kept.columns == edge.columns and kept.count() <= len(ROWS)


def slow_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def components_of(ids, linked):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    low = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return [low[find(i)] for i in range(len(ids))]


def test_simhash_equals_brute_force(spark, edge, nothing):
    rows = [(i, t) for i, t, *_ in ROWS]
    fps = [slow_simhash(t) if i != 9 else simhash.fingerprint(t) for i, t in rows]
    comp = components_of([i for i, _ in rows], lambda a, b: bin(fps[a] ^ fps[b]).count("1") <= 3)
    want = sorted(zip([str(i) for i, _ in rows], [f"{f:016x}" for f in fps], map(str, comp), strict=True))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in simhash.near_duplicates(edge).collect()) == want
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.keep_first(edge)
    assert kept.columns == edge.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted({i for (i, _), c in zip(rows, comp, strict=True) if i is not None and i == c})


@pytest.mark.parametrize("hot", [1, 64])
def test_links_lose_no_pair(spark, hot):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 63, 6, dtype=np.int64)
    fps = {int(b) for b in base}
    for b in base:
        for _ in range(60):
            f = int(b) & 0xFFFFFFFFFFFFFFFF
            for k in rng.choice(64, rng.integers(0, 5), replace=False):
                f ^= 1 << int(k)
            fps.add(f - (1 << 64) if f >= 1 << 63 else f)
    fps = sorted(fps)
    want = {(a, b) for i, b in enumerate(fps) for a in fps[:i] if bin((a ^ b) & 0xFFFFFFFFFFFFFFFF).count("1") <= 3}
    got = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), hot_bucket=hot).collect()
    assert {(r["a"], r["b"]) for r in got} == want and len(got) == len(want)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints(spark, edge, nothing):
    rows = sorted([(i, t or "") for i, t, *_ in ROWS if i is not None and i != 2], key=lambda r: r[0])
    df = edge.filter("doc_id is not null and doc_id <> 2")
    got = {r["doc_id"]: r for r in fingerprints.compare_with_next(df).collect()}
    for k, (i, t) in enumerate(rows):
        e = fingerprints.edited(t, rows[(k + 1) % len(rows)][1])
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        a, b = set(fingerprints.digests(t).tolist()), set(fingerprints.digests(e).tolist())
        assert abs(r["near_edited"] - (len(a & b) / len(a | b) if a | b else 1.0)) < 1e-9
    assert got[1]["fingerprint"] == got[3]["fingerprint"] and got[1]["near_edited"] > 0.3 and got[3]["near_edited"] > got[3]["near_next"]
    whole = fingerprints.compare_with_next(edge).collect()
    assert len(whole) == len(ROWS) and len({r["fingerprint"] for r in whole if r["doc_id"] == 2}) == 1
    assert fingerprints.compare_with_next(nothing).count() == 0 and fingerprints.compare_with_next(edge.filter("doc_id = 1")).first()["near_next"] == 1.0
    plain = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint_documents(df).collect()}
    assert plain == {i: r["fingerprint"] for i, r in got.items()}


def test_short_repeated_paragraphs_keep_digests_of_their_own():
    text = "\n".join(f"{a}{b}" for a in "abcdefgh" for b in ("", "x", "y")) * 1 + "\na" * 2000
    d = fingerprints.digests(text)
    assert len(d) == len(set(d.tolist())) == 24 + 2000
    assert abs(fingerprints.likeness([d], [fingerprints.digests("a\nb")])[0] - 2 / 2024) < 1e-9


@pytest.mark.parametrize("n", [0, 1, 10, 400])
def test_sketches_recover_differences(n):
    rng = np.random.default_rng(n)
    common, a, b = (rng.integers(0, 1 << 64, k, dtype=np.uint64) for k in (300, n, 2 * n))
    more, less = fingerprints.differences([np.concatenate([common, a])], [np.concatenate([b, common])])[0]
    assert set(more.tolist()) == set(a.tolist()) and set(less.tolist()) == set(b.tolist())


def shared_windows(texts, n):
    seen, out = {}, set()
    for i, t in enumerate(texts):
        w = (t or "").split()
        for k in range(len(w) - n + 1):
            j = seen.setdefault(" ".join(w[k : k + n]), i)
            if j != i:
                out |= {i, j}
    return out


def test_passages_that_repeat_are_removed_and_others_stay(spark):
    passage = prose(500, 60)
    clean = [(i, prose(i, 150), "s") for i in range(20)]
    hosts = [(100 + i, " ".join(prose(100 + i, 90).split()[: 30 + i]) + " " + passage + " " + prose(200 + i, 50), "s") for i in range(6)]
    near = "alpha " + " ".join(f"n{i}" for i in range(80))
    lines = [(300, prose(301, 30) + "\n" + near + " omega", "s"), (302, near + " zeta\n" + prose(303, 30), "s")]
    got = {r["doc_id"]: r for r in substring_dedup.dedup_substrings(docs(spark, *clean, *hosts, *lines)).collect()}
    assert all(got[i]["text"] == t and not got[i]["changed"] for i, t, _ in clean)
    assert not shared_windows([got[i]["text"] for i, *_ in hosts], 30) and got[100]["text"] == hosts[0][1] and all(got[i]["keeper_id"] == 100 for i, *_ in hosts[1:])
    assert "n40" in got[300]["text"] and "n40" not in got[302]["text"] and prose(303, 30) in got[302]["text"]


def test_substring_dedup_on_edges(edge, nothing):
    got = substring_dedup.dedup_substrings(edge, carry=("lang", "score"))
    rows = got.collect()
    texts = {(i, t) for i, t, *_ in ROWS}
    assert len(rows) == len(ROWS) and all(r["changed"] or (r["doc_id"], r["text"]) in texts for r in rows)
    assert [r["text"] for r in rows if r["doc_id"] == 3] == [""] and all(not r["changed"] for r in rows if r["doc_id"] in (1, 2))
    assert got.columns[:3] == ["lang", "score", "doc_id"] and substring_dedup.dedup_substrings(nothing).count() == 0


def test_bands_reach_the_recall_they_are_tuned_for():
    b = substring_dedup.tune_bands()
    assert 1 - (1 - 0.8**substring_dedup.ROWS) ** b >= 0.98 > 1 - (1 - 0.8**substring_dedup.ROWS) ** (b - 1)
    rng, hit = np.random.default_rng(1), 0
    for _ in range(300):
        s = rng.integers(0, 1 << 64, 100, dtype=np.uint64)
        x, y = s[:90], s[10:]
        k = substring_dedup._minhash(np.concatenate([x, y]), np.array([0, 90]), np.array([90, 180]), b, substring_dedup.ROWS)
        hit += bool((k[0] == k[1]).any())
    assert hit >= 0.95 * 300


PAGE = "<html><head><title>T</title></head><body><nav><ul><li><a>Home</a></li></ul></nav>{main}<div class='ad'>Buy</div><footer>&copy; x</footer></body></html>"


def test_html_lines():
    html = PAGE.format(main="<article><h1>Head &amp; tail</h1><p><b>One<br><p>Two\n  &nbsp;words</p><script>var t='</p>';</script><aside>no</aside><section class='comments'><p>bad</p></section></article>")
    kept = [t for t, z in html_extract.page_lines(html) if z == html_extract.ARTICLE]
    assert kept == ["Head & tail", "One", "Two words"]
    assert html_extract.page_lines("") == [] and html_extract.page_lines("<p>a < b<div") == [("a < b", html_extract.PLAIN)]


def test_common_lines_are_a_longest_common_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(0, 12)).tolist(), rng.integers(0, 4, rng.integers(0, 12)).tolist()
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        got = sorted(html_extract.common_lines(a, b))
        assert len(got) == best[-1][-1]
        it = iter(b)
        assert all(a[i] in it for i in got)


def test_html_extraction(spark):
    plain = lambda i: PAGE.format(main=f"<div>Site menu line</div><div>{prose(i, 12)}</div><div>All rights kept</div>")
    rows = [(i, f"http://h.example/{i:02d}", plain(i)) for i in range(12)] + [(50, "http://k.example/a", PAGE.format(main=f"<article><p>{prose(1, 9)}</p></article>")), (51, "http://k.example/b", PAGE.format(main=f"<article><p>{prose(1, 9)}</p></article>"))]
    rows += [(None, None, None), (60, "", ""), (60, "", ""), (61, "no url", "<p>x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as host", "3 as edge")
    got = html_extract.extract(df).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and all(text[i] == prose(i, 12) for i in range(12))
    assert text[50] == text[51] == prose(1, 9) and text[None] == text[60] == "" and text[61] == "x"
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_extract.extract(df.limit(0)).count() == 0
