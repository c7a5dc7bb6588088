import random

import pytest

from strataflow.operators import transitions

STEPS = [(None, "a"), ("a", "b"), ("b", "a"), ("b", "b"), ("a", "done"), ("b", "done")]


def slow(rows):
    out, last = [], {}
    for key, at, state in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        before = last.get(key, ())
        legal = state is not None and ((None, state) in STEPS if not before else before[0] is not None and (before[0], state) in STEPS)
        if not legal:
            out.append((key, at, state, before[0] if before else None))
        last[key] = (state,)
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_illegal_transitions_of_a_log_with_a_hot_key(spark, partitions):
    rng = random.Random(3)
    rows = [("hot", i, rng.choice(["a", "b", "b", "b"])) for i in range(400)] + [(f"k{i % 90}", i, rng.choice(["a", "b", "done", None])) for i in range(500)] + [(None, i, "a") for i in range(3)]
    df = spark.createDataFrame(rows, "key string, at int, state string").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = transitions.illegal_transitions(df, ["key"], ["at"], "state", STEPS)
        assert got.columns == ["key", "at", "state", "previous"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == slow(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_an_empty_log_and_a_finished_attempt(spark):
    none = spark.createDataFrame([], "key string, at int, state string")
    assert transitions.illegal_transitions(none, ["key"], ["at"], "state", STEPS).count() == 0
    log = spark.createDataFrame([("x", 1, "a"), ("x", 2, "done"), ("x", 3, "done"), ("y", 1, "done")], "key string, at int, state string")
    assert sorted(tuple(r) for r in transitions.illegal_transitions(log, ["key"], ["at"], "state", STEPS).collect()) == [("x", 3, "done", "done"), ("y", 1, "done", None)]
