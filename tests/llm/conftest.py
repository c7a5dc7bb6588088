import random

import pytest
from pyspark.sql import functions as F

#: Columns whose names the operators' results and intermediate tables use too.
CLASH = ("n_tokens", "n_bytes", "score", "fingerprint", "component_id", "h", "doc", "version", "words", "host", "piece", "length", "__group", "range", "guest", "kept", "lang_pred")
DDL = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int, stock: str = "the of and to in is was for that with alpha beta gamma delta river stone garden window market engine") -> str:
    r = random.Random(seed)
    names = stock.split() + [f"w{seed}x{i}" for i in range(40)]
    out = []
    while len(out) < words:
        n = r.randrange(7, 14)
        s = [r.choice(names) for _ in range(n)]
        out += [s[0].capitalize(), *s[1:-1], s[-1] + "."]
    return " ".join(out)


ROWS = [
    (1, prose(1, 120), "en", "a"), (2, prose(2, 200), "en", "a"), (2, prose(2, 200), "en", "a"), (3, prose(1, 120), "en", "b"), (None, prose(3, 60), "en", None),
    (None, None, None, None), (4, None, "en", "a"), (5, "", "en", "a"), (6, " \n\t ", None, "b"), (7, "x", "en", "b"), (8, "ab" * 30_000, "en", "b"), (9, prose(4, 40_000), "en", "a"),
    (10, "1 2 3 ... !!", "en", "a"), (11, "a b　c d ́e \U0001f600 <s> <|endoftext|> ▁ \x1c", "en", "a"), (-5, "Short line one.\nShort line one.\n\nOther", "fr", "c"),
]


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(*r, len(r[1] or "")) for r in ROWS]
    return spark.createDataFrame(rows, DDL).repartition(3).withColumns({c: F.lit("clash") for c in CLASH})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DDL)


def by_text(df, column):
    """Results keyed by (id, row), as a sorted list that survives repeated rows and null ids."""
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0, str(r[column])) for r in df.collect()))
