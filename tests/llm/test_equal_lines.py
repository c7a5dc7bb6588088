"""Equal paragraphs, and rows of one id that a short digest does not tell apart."""

import random

import pytest
from pyspark.sql import functions as F

from strataflow.llm import substring_dedup

from .conftest import DDL


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DDL)


def shingles(line):
    w = line.split()
    return {" ".join(w[j : j + 5]) for j in range(len(w) - 4)}


def test_equal_and_near_lines_of_20_to_49_words_go(spark):
    rng = random.Random(12)
    own = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    equal = [own(n) for n in (20, 21, 30, 49)]
    short = own(19)
    near = own(40)
    changed = " ".join([*near.split()[:-1], "other"])
    rows = [(1, "\n".join([own(30), *equal, short, near])), (2, "\n".join([equal[0], own(25), equal[1]])), (3, f"{own(22)}\n{equal[2]}\n{short}"), (4, equal[3]), (5, f"{changed}\n{own(24)}"), (6, f"{changed}\n{near}"), (7, own(60))]
    rng.shuffle(rows)
    got = {r["doc_id"]: r for r in substring_dedup.dedup_substrings(docs(spark, rows)).collect()}
    texts = dict(rows)
    seen, lost, kept = [], 0, 0
    for i in sorted(texts):
        lines = [x for x in texts[i].split("\n")]
        for line in lines:
            gone = line not in got[i]["text"].split("\n")
            mine = shingles(line)
            repeats = len(line.split()) >= 20 and any(len(mine & s) >= 0.8 * len(mine | s) for s in seen)
            assert gone == repeats, (i, line[:40])
            lost, kept = lost + gone, kept + (not gone)
        seen += [shingles(x) for x in lines if len(x.split()) >= 20]
    assert lost == 7 and got[2]["keeper_id"] == 1 and got[4]["text"] == "" and got[6]["n_removed_words"] == 80


def test_a_hot_line_goes_from_all_but_the_first(spark):
    line = " ".join(f"notice{k}" for k in range(30))
    rows = [(i, f"own words of {i} alone\n{line}") for i in range(500)]
    got = substring_dedup.dedup_substrings(docs(spark, rows).repartition(6)).collect()
    assert {r["doc_id"] for r in got if not r["changed"]} == {0} and {r["keeper_id"] for r in got if r["changed"]} == {0}
    assert all(r["text"] == f"own words of {r['doc_id']} alone" for r in got if r["changed"])


def test_texts_of_one_32_bit_hash_under_one_id_are_not_mixed(spark):
    """Spans are found for a row and cut from that row: a short hash of the text would name two."""
    made = spark.range(300_000).select(F.concat_ws(" ", *[F.concat(F.lit(f"x{k}y"), F.col("id").cast("string")) for k in range(31)]).alias("t"))
    pairs = made.groupBy(F.hash("t").alias("h")).agg(F.min("t").alias("a"), F.max("t").alias("b")).filter("a < b").limit(1).collect()
    assert pairs, "no two of the texts have one 32-bit hash"
    a, b = pairs[0]["a"], pairs[0]["b"]
    rows = [(1, a), (5, a), (5, b)]
    got = sorted((r["doc_id"], r["text"], r["n_removed_words"]) for r in substring_dedup.dedup_substrings(docs(spark, rows)).collect())
    assert got == sorted([(1, a, 0), (5, "", 31), (5, b, 0)])


def test_columns_of_the_result_cannot_be_carried(spark):
    df = docs(spark, [(1, "a")]).withColumn("changed", F.lit(1))
    with pytest.raises(ValueError, match="changed"):
        substring_dedup.dedup_substrings(df, carry=("changed",))
