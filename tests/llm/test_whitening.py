"""Whitening against numpy's eigenvectors and whole numbers of any size."""

import math

import numpy as np
import pytest

from strataflow.llm import whitening

from .conftest import CLASH


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def slow(vectors, k=4):
    x = np.array([[math.floor(256 * float(c)) for c in v] for v in vectors], dtype=float)
    fit = np.unique(x, axis=0)
    mean = fit.mean(axis=0)
    value, vector = np.linalg.eigh((fit - mean).T @ (fit - mean) / len(fit))
    value, vector = value[::-1][:k], vector[:, ::-1][:, :k]
    sums = [int(s) for s in fit.sum(axis=0)]
    deviation = [sum((len(fit) * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return len(fit), deviation, (x - mean) @ vector / np.sqrt(value), value / ((fit - mean) ** 2).sum() * len(fit)


@pytest.mark.parametrize("dims,rows,kind", [(64, 700, "float"), (30, 12, "double"), (3, 50, "float"), (1, 9, "double")])
def test_components_equal_a_full_decomposition(spark, dims, rows, kind):
    rng = np.random.default_rng(dims)
    base = (rng.normal(size=(rows, dims)) * np.linspace(0.2, 0.1, dims)).astype(np.float32).astype(float).tolist()
    vectors = base + [base[0]] * (rows // 2) + base[: rows // 3]  # one vector a third of all rows
    bad = [(-1, None, 0), (-2, [0.0] * (dims - 1) + [None], 0), (-3, [float("nan")] * dims, 0), (-4, [0.0] * (dims - 1) + [float("-inf")], 0)]
    df = table(spark, [(i, v, 0) for i, v in enumerate(vectors)] + bad, kind).repartition(5)
    got = whitening.whiten(df).toPandas()
    n, deviation, want, explained = slow(vectors, min(4, dims))
    k = want.shape[1]
    assert len(got) == len(vectors) * k and set(got["n"]) == {n}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].max() < 1e-9 and got["residual"].max() < 1e-9
    for j in range(k):
        one = got[got["component"] == j + 1].sort_values("vec_id")
        assert one["deviation"].tolist() == deviation and np.allclose(one["explained"], explained[j], rtol=1e-9)
        sign = np.sign(one["whitened"].to_numpy() @ want[:, j])
        assert np.allclose(one["whitened"].to_numpy() * sign, want[:, j], atol=1e-7)


def test_equal_eigenvalues_still_whiten(spark):
    rows = [(2 * i + s, [float(1 - 2 * s) if j == i else 0.0 for j in range(8)], 0) for i in range(8) for s in range(2)]
    got = whitening.whiten(table(spark, rows)).toPandas().pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert got.shape == (16, 4) and np.allclose(got.T @ got / 16, np.eye(4), atol=1e-9)


def test_edges(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None, 0), (2, [float("nan")], 0)])).count() == 0
    assert whitening.whiten(table(spark, [(1, [], 0), (2, [], 0)])).count() == 0
    assert whitening.whiten(table(spark, [(1, [0.5, 1.0], 0)] * 3)).count() == 0  # one distinct vector has no variance
    line = whitening.whiten(table(spark, [(None, [float(i), 2.0 * i], 0) for i in range(4)]).selectExpr("*", *(f"1 as {c}" for c in CLASH if c != "n"))).toPandas()
    assert len(line) == 4 and set(line["component"]) == {1} and line["vec_id"].isna().all() and np.allclose(line["explained"], 1.0)
    short = whitening.whiten(table(spark, [(1, [1.0], 0), (2, [1.0, 0.0], 0), (3, [0.0, 3.0], 0)])).toPandas()
    assert set(short["n"]) == {2} and len(short) == 3  # the first two are the same vector
    huge = whitening.whiten(table(spark, [(1, [1e30], 0), (2, [-1e30], 0), (3, [0.0], 0)], "double")).toPandas()
    assert huge["deviation"].isna().tolist().count(True) == 2 and len(huge) == 3


def test_floor_is_of_the_double_product(spark):
    got = whitening.rounded_vectors(table(spark, [(1, [-0.001, -0.0, 0.00390625, 1.9999999], 0)], "double")).first()["x"]
    assert got == [-1, 0, 1, 511]


def test_unreachable_residual_raises(monkeypatch):
    monkeypatch.setattr(whitening, "MOST_ROUNDS", 3)
    rng = np.random.default_rng(0)
    with pytest.raises(ArithmeticError):
        whitening.lobpcg(lambda block: rng.normal(size=(40, 40)) @ block, 40, 2, 2)
