"""Embedding whitening: LOBPCG by distributed covariance-block products."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from strataflow.llm.arrow import by_bytes, exclusive, in_arrow
from strataflow.llm.scratch import discard, stored

#: Factor of an entry before it is rounded down.
STEPS = 256
#: Components that are returned, and columns that the iterate has besides them: neighbouring eigenvalues may be close.
COMPONENTS, GUARD = 4, 16
#: A residual, as a share of the largest eigenvalue, that ends the iteration at once; one that certifies when it falls no more; rounds at most.
GOAL, CERTIFIED, MOST_ROUNDS = 2e-15, 1e-11, 300
#: Share of the largest eigenvalue up to which a variance counts as none.
NO_VARIANCE = 1e-12


@dataclass
class Whitening:
    """``components`` (dimensions x k) are unit eigenvectors by falling ``values``; ``residual`` is the norm of what each misses."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    components: np.ndarray
    residual: np.ndarray
    identity_error: float


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of a list column as doubles, NaN for null ones, each list's start and length."""
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    return flat, np.cumsum(size) - size, size


def rounded_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", steps: int = STEPS) -> DataFrame:
    """``id_col`` and ``x``, the entries times ``steps`` rounded down, of each row with a vector of finite numbers.

    Rows whose vector is null or holds a null or non-finite entry go; repeated rows and null ids stay. Entries
    beyond a long become its nearest value. Map-only.
    """
    schema = StructType([StructField(id_col, df.schema[id_col].dataType), StructField("x", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exclusive("whitening")
        for batch in batches:
            for part in by_bytes(batch):
                flat, start, size = _lists(part.column(1))
                bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
                ok = (bad[start + size] == bad[start]) & pc.is_valid(part.column(1)).to_numpy(zero_copy_only=False)
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(flat * steps)
                    whole = np.where(x >= 2.0**63, np.iinfo(np.int64).max, np.where(x < -(2.0**63), np.iinfo(np.int64).min, np.nan_to_num(x).astype(np.int64)))
                lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(flat)), pa.int32()), pa.array(whole, pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[id_col, "x"]).filter(pa.array(ok))

    return df.select(id_col, vec_col).transform(in_arrow, run, schema)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column of longs, shorter ones with zeros behind."""
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (size == dims).all():
        return flat.reshape(len(size), dims)
    out = np.zeros((len(size), dims), dtype=np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for batch in batches:
            for part in by_bytes(batch):
                x = _matrix(part.column(0), dims)
                n += len(x)
                safe = not len(x) or float(np.abs(x.astype(np.float64)).max()) * len(x) < 2.0**62
                total = [a + int(b) for a, b in zip(total, x.sum(axis=0) if safe else x.astype(object).sum(axis=0), strict=True)]
        if n:
            whole = pa.array([Decimal(v) for v in [n, *total]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, dims), pa.int32()), whole], names=["dim", "s"])

    got = {r["dim"]: int(r["s"]) for r in in_arrow(fit, run, "dim int, s decimal(38,0)").groupBy("dim").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect()}
    return got.get(-1, 0), [got.get(i, 0) for i in range(dims)]


def covariance_product(fit: DataFrame, n: int, sums: list[int], block: np.ndarray) -> tuple[np.ndarray, float]:
    """The covariance of the centred rows times ``block``, and its trace, in one pass: a row of sums per dimension and task is shuffled."""
    dims, k = block.shape
    mean = np.array([float(s) for s in sums]) / n
    names = [f"b{j}" for j in range(k + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exclusive("whitening")
        total = np.zeros((dims, k + 1))
        for batch in batches:
            for part in by_bytes(batch):
                c = _matrix(part.column(0), dims) - mean
                total[:, :k] += c.T @ (c @ block)
                total[:, k] += (c * c).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), *(pa.array(total[:, j]) for j in range(k + 1))], names=["dim", *names])

    schema = StructType([StructField("dim", IntegerType()), *(StructField(c, DoubleType()) for c in names)])
    table = in_arrow(fit, run, schema).groupBy("dim").agg(*(F.sum(c).alias(c) for c in names)).toArrow().sort_by("dim")
    out = np.stack([table[c].to_numpy() for c in names], axis=1) / n
    return out[:, :k], float(out[:, k].sum())


def _orthonormal(blocks: list[np.ndarray]) -> np.ndarray:
    """An orthonormal basis of the blocks' columns, in their order; columns that add nothing are left out."""
    basis = np.zeros((len(blocks[0]), 0))
    for block in blocks:
        for column in block.T:
            size = np.linalg.norm(column)
            if size == 0 or basis.shape[1] == len(basis):
                continue
            v = column / size
            for _ in range(3):
                v = v - basis @ (basis.T @ v)
                left = np.linalg.norm(v)
                if left < 1e-9:
                    break
                v /= left
            else:
                basis = np.column_stack([basis, v])
    return basis


def lobpcg(product: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, guard: int = GUARD, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric operator, unit eigenvectors, and the norms of their residuals.

    A round multiplies an orthonormal basis of the iterate, the residuals and the previous direction, and solves
    the small problem on it (Rayleigh-Ritz). As the product is of the whole basis each time, residuals are those of
    the vectors at hand, not carried on. Rounds end when the residuals of the wanted ones reach ``GOAL``, or are
    certified and fall no more; a residual that stays above ``CERTIFIED`` raises.
    """
    m = min(dims, wanted + guard)
    basis = _orthonormal([np.random.default_rng(seed).normal(size=(dims, m))])
    best, stale, kept = np.inf, 0, None
    for _ in range(MOST_ROUNDS):
        image = product(basis)
        small = basis.T @ image
        value, turn = np.linalg.eigh((small + small.T) / 2)
        value, turn = value[::-1][:m], turn[:, ::-1][:, :m]
        x, vx = basis @ turn, image @ turn
        residual = vx - x * value
        size = np.linalg.norm(residual[:, :wanted], axis=0)
        top = max(value[0], 0.0)
        worst = size.max() / top if top > 0 else 0.0
        if worst < 0.5 * best:
            stale = 0
        else:
            stale += 1
        if kept is None or worst < best:
            best, kept = worst, (value[:wanted], x[:, :wanted], size)
        if best <= GOAL or best <= CERTIFIED and stale >= 3:
            return kept
        direction = basis[:, m:] @ turn[m:] if basis.shape[1] > m else np.zeros((dims, 0))
        basis = _orthonormal([x, residual, direction])
    raise ArithmeticError(f"residual {best:.2g} of the largest eigenvalue after {MOST_ROUNDS} rounds")


def fit_whitening(rows: DataFrame, components: int = COMPONENTS, guard: int = GUARD) -> Whitening | None:
    """Principal components of the distinct vectors ``x`` of ``rows``; None without a row or a dimension.

    Vectors shorter than the longest count as followed by zeros. The driver holds blocks of a few columns by
    the number of dimensions, whatever the number of rows; the covariance itself is never formed.
    """
    size = rows.agg(F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")).first()
    dims = size["high"] or 0
    if not dims:
        return None
    x = F.col("x")
    if size["low"] < dims:
        x = F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x")))
    fit = stored(rows.select(x.alias("x")).distinct(), "distinct")
    n, sums = _sums(fit, dims)
    value, vector, residual = lobpcg(lambda block: covariance_product(fit, n, sums, block)[0], dims, min(components, dims), guard)
    keep = value > NO_VARIANCE * max(value[0], 0.0) if value[0] > 0 else np.zeros(len(value), bool)
    value, vector, residual = value[keep], vector[:, keep], residual[keep]
    scaled = vector / np.sqrt(value)
    image, trace = covariance_product(fit, n, sums, scaled)
    error = float(np.abs(scaled.T @ image - np.eye(len(value))).max()) if len(value) else 0.0
    discard(fit)
    return Whitening(n, sums, trace, value, vector, residual, error)


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None beyond a long."""
    if not x.size:
        return [0] * len(x)
    most = n * float(np.abs(x.astype(np.float64)).max()) + max(abs(float(s)) for s in sums)
    if most * most * x.shape[1] < 2.0**62:
        return ((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, dtype=object)) ** 2).sum(axis=1)
    return [int(v) if v < 2**63 else None for v in exact]


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS, steps: int = STEPS) -> DataFrame:
    """Whitened leading components of each row's vector, a row per row and component.

    Returns ``id_col``, ``component`` (from 1), ``n`` (distinct vectors), ``deviation``, ``whitened``, ``explained``,
    ``identity_error`` and ``residual``, the certified residual norm of the component as a share of its eigenvalue.
    Repeated rows and null ids stay, other columns are not read. Rows without a vector, or with a null or
    non-finite entry, have no result. Components without variance are left out: one distinct vector, or an empty
    table, gives no row. A deviation beyond a long is null. Components of equal eigenvalues are some orthonormal
    basis, the same for all rows.
    """
    rows = rounded_vectors(df, id_col, vec_col, steps)
    model = fit_whitening(rows, components)
    schema = StructType(
        [StructField(id_col, df.schema[id_col].dataType), StructField("component", IntegerType()), StructField("n", LongType()), StructField("deviation", LongType())]
        + [StructField(c, DoubleType()) for c in ("whitened", "explained", "identity_error", "residual")]
    )
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    k, dims = len(model.values), len(model.sums)
    mean = np.array([float(s) for s in model.sums]) / model.n
    scaled = model.components / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch):
                x = _matrix(part.column(1), dims)
                at = np.repeat(np.arange(len(x)), k)
                white = ((x - mean) @ scaled).ravel()
                each = lambda v: pa.array(np.tile(v, len(x)))
                columns = [part.column(0).take(pa.array(at)), each(np.arange(1, k + 1, dtype=np.int32)), each(np.full(k, model.n)), pa.array(_deviation(x, model.n, model.sums), pa.int64()).take(pa.array(at))]
                columns += [pa.array(white), each(model.values / model.trace), each(np.full(k, model.identity_error)), each(model.residual / model.values)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return in_arrow(rows, run, schema)
