import random

import numpy as np

from strataflow.llm import substring_dedup

from .conftest import DDL, prose


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DDL)


def in_runs(rows, least):
    """Places of the words of each row that lie in a run of ``least`` words which a row of a smaller id has too."""
    seen, out = {}, {}
    for i, t in sorted(rows):
        w = t.split()
        k = [" ".join(w[j : j + least]) for j in range(len(w) - least + 1)]
        out[i] = {j + n for j, x in enumerate(k) if seen.get(x, i) != i for n in range(least)}
        for x in k:
            seen.setdefault(x, i)
    return out


def removed(row, text):
    """Places of the words of ``text`` that the row's spans cover."""
    raw, out = text.encode(), set()
    for s in row["spans"]:
        first = len(raw[: s["start"]].split())
        assert s["words"] == len(raw[s["start"] : s["stop"]].split())
        out |= set(range(first, first + s["words"]))
    return out


def test_every_run_of_over_50_words_is_found_whole(spark):
    rng = random.Random(5)
    own = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    passages = [own(51), own(52), own(65), own(120), prose(7, 60).split(), ["so"] * 60, ["ha", "ho", "hum"] * 18, "a b. c d e f g! ".split() * 12]
    rows = []
    for n, p in enumerate(passages):  # in mid-sentence, ahead, at the end, alone, and in parts of which another row has more
        rows += [(10 * n, " ".join(own(33) + p + own(40))), (10 * n + 1, " ".join([*own(7), "End.", *own(3)] + p + own(61))), (10 * n + 2, " ".join(p + own(30))), (10 * n + 3, " ".join(own(90) + p)), (10 * n + 4, " ".join(p)), (10 * n + 5, " ".join(own(5) + p[:51] + own(50) + p[-51:] + own(5)))]
    long = own(300)
    rows += [(900, " ".join(long[:170] + own(9))), (901, " ".join(own(9) + long[120:])), (902, " ".join(own(11) + long + own(11))), (903, "\n".join([" ".join(long[40:77]), " ".join(long[77:140])]))]
    rng.shuffle(rows)
    texts = dict(rows)
    want, allowed = in_runs(rows, 50), in_runs(rows, 20)
    got = {r["doc_id"]: r for r in substring_dedup.dedup_substrings(docs(spark, *rows)).collect()}
    found = {i: removed(got[i], texts[i]) for i in texts}
    assert sum(map(len, want.values())) > 2000
    assert not {i: sorted(want[i] - found[i]) for i in texts if want[i] - found[i]}
    assert not {i: sorted(found[i] - allowed[i]) for i in texts if found[i] - allowed[i]}


def test_chosen_windows_are_the_last_least_ones():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 31, 200):
        for high in (3, 1 << 60):
            x = rng.integers(0, high, n).astype(np.uint64)
            mixed = substring_dedup._mix(x)
            width = min(31, n)
            want = {max(range(j, j + width), key=lambda i: (-int(mixed[i] >> np.uint64(24)), i)) for j in range(n - width + 1)} if n else set()
            assert set(substring_dedup.chosen(x, 31).tolist()) == want
