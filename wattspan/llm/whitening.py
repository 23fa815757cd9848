"""Embedding whitening: exact covariance, float32 eigenvectors, refinement in higher precision.

Components are scaled to integers (`floor(64 c) + 1000000`). A first pass sums them; a second one sums
the products of what is left after taking off the integer nearest to each mean. Both are sums of
integers, so they are exact and don't depend on partitions, and the small rest of the means is taken
off in exact integers: no large offset is ever squared.

Eigenvectors: LAPACK in float32, then Ogita-Aishima iterations, whose matrix products run in extended
precision: from R = I - X'X and S = X'AX each correction E of X has entries
(S_ij + l_j R_ij) / (l_j - l_i), or R_ij / 2 where two values lie too close to tell the vectors apart.
The vectors of each such cluster are found by an eigenproblem of their own: the matrix less the
cluster's mean value, projected on them, is small and its entries are well scaled, so its float64
vectors part them; they are rotated by these and refined again.

The covariance of the whitened rows, for the identity error, is summed over the rows as returned, in a
third pass.

Defined results: rows whose vector is NULL, empty, has a NULL or non-finite component or one of
`LARGEST` or more in size, or another length than most vectors are left out, and no others: rows with
a repeated or NULL vec_id are rows of their own. A component's largest entry (the first of equal ones)
is positive. Components whose eigenvalue is below 2^-40 of the trace can't be scaled and are left out,
so constant vectors, a single row or an empty table give no rows. `deviation` is a long: beyond about
2^63 the query raises an overflow error instead of returning a wrong figure. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import matrix, usable

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
LARGEST = float(1 << 40)
ROUNDS = 12
_EXACT = float(1 << 53)
_WIDE = np.longdouble


def integers(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors).astype(np.int64) + SHIFT


def _cells(dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(dim)


def _product(left: np.ndarray) -> np.ndarray:
    """left' left as exact Python integers, over float64 products where they are exact."""
    top = float(np.abs(left).max(initial=0))
    if top * top * len(left) < _EXACT:
        whole = left.astype(np.float64)
        return (whole.T @ whole).astype(np.int64).astype(object)
    wide = left.astype(object)
    return wide.T @ wide


def sums(rows: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of each dimension."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, np.zeros(dim, dtype=object)
        for batch in batches:
            count += batch.num_rows
            total = total + integers(matrix(batch.column(0), dim)).sum(axis=0).astype(object)
        yield _totals([count, *total])

    found = _added(rows, add)
    return found[0], found[1:]


def _totals(values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(range(len(values)), pa.int32()),
        pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))], names=["at", "v"])


def _added(rows: DataFrame, add) -> list[int]:
    """Sums of what the tasks return, by place: as many numbers as places, whatever the rows."""
    parts = rows.select("vector").mapInArrow(add, "at int, v decimal(38,0)")
    return [int(r.v) for r in parts.groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()]


def covariance(rows: DataFrame, dim: int, n: int, total: list[int]) -> np.ndarray:
    """The covariance times n * n, as exact integers."""
    middle = [(2 * s + n) // (2 * n) for s in total]
    offset, cells = np.array(middle, dtype=np.int64), _cells(dim)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((dim, dim), dtype=object)
        for batch in batches:
            products = products + _product(integers(matrix(batch.column(0), dim)) - offset)
        yield _totals(products[cells])

    products = _added(rows, add)
    rest = [s - n * m for s, m in zip(total, middle)]
    out = np.zeros((dim, dim), dtype=object)
    for i, j, value in zip(*cells, products):
        out[i, j] = out[j, i] = n * value - rest[i] * rest[j]
    return out


def refined(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix in extended precision."""
    dim = len(a)
    x = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(_WIDE)
    one, norm = np.eye(dim, dtype=_WIDE), np.abs(a).sum(axis=1).max()
    tiny = np.finfo(_WIDE).eps
    for _ in range(ROUNDS):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2  # else rounding, divided by a small gap, costs orthogonality
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        spread = 2 * (np.sqrt((off ** 2).sum()) + norm * np.sqrt((r ** 2).sum()))
        apart = values[None, :] - values[:, None]
        close = np.abs(apart) <= spread
        step = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, apart))
        x = x + x @ step
        clusters = [c for c in _clusters(values, spread) if len(c) > 1]
        for members in clusters:
            x[:, members] = _parted(a, x[:, members], values[members].mean())
        if not clusters and np.abs(step).max() <= 64 * dim * tiny or norm == 0:
            break
    x = _orthonormal(x)
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def _clusters(values: np.ndarray, spread) -> list[np.ndarray]:
    """Runs of sorted eigenvalues with gaps of at most `spread`."""
    order = np.argsort(values, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(values[order]) > spread) + 1)


def _parted(a: np.ndarray, x: np.ndarray, middle) -> np.ndarray:
    """The cluster's vectors, made orthonormal and turned to the eigenvectors of their own small problem.

    What is solved is a - middle * I on their span, scaled by its own size: gaps that vanish beside the
    whole matrix's eigenvalues are large there.
    """
    x = _orthonormal(x)
    small = x.T @ (a @ x - middle * x)
    size = np.abs(small).max()
    if size == 0:
        return x
    turn = np.linalg.eigh(((small + small.T) / (2 * size)).astype(np.float64))[1].astype(_WIDE)
    return x @ _orthonormal(turn)


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Newton steps to the nearest orthonormal basis of nearly orthonormal columns."""
    for _ in range(3):
        x = x + x @ (np.eye(x.shape[1], dtype=_WIDE) - x.T @ x) / 2
    return x


def _wide(value: int) -> np.longdouble:
    """A Python integer in extended precision, its low bits included."""
    high, low = divmod(value, 1 << 60)
    return _WIDE(float(high >> 53 << 53)) * _WIDE(2 ** 60) + _WIDE(high - (high >> 53 << 53)) * _WIDE(2 ** 60) + _WIDE(low)


def whitened(table: DataFrame, id_column: str, vector: str, components: int = COMPONENTS) -> DataFrame:
    """Per row and component: the whitened value and the figures of the fit."""
    own = table.select(F.col(id_column).alias("vec_id"), F.col(vector).alias("vector"))
    small = F.coalesce(F.forall("vector", lambda x: F.abs(x.cast("double")) < LARGEST), F.lit(False))
    rows = usable(own.where(small), "vector")
    dim = (rows.agg(F.max(F.size("vector"))).first()[0]) or 0
    plain = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    n, total = sums(rows, dim) if dim else (0, [])
    if not n:
        return table.sparkSession.createDataFrame([], plain)
    exact = covariance(rows, dim, n, total)
    a = np.array([[_wide(v) for v in line] for line in exact], dtype=_WIDE) / _WIDE(n) / _WIDE(n)
    values, vectors = refined(a)
    trace = np.trace(a)
    kept = int((values[:components] > trace * _WIDE(2.0 ** -40)).sum())
    if not kept:
        return table.sparkSession.createDataFrame([], plain)
    vectors = vectors[:, :kept]
    lead = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[lead, np.arange(kept)] < 0, -1, 1)
    scaled = (vectors / np.sqrt(values[:kept])).astype(np.float64)
    middle = np.array([(2 * s + n) // (2 * n) for s in total], dtype=np.int64)
    rest = np.array([s - n * int(m) for s, m in zip(total, middle)], dtype=np.int64)
    fraction = np.array([float(_WIDE(int(r)) / _WIDE(n)) for r in rest])

    def project(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        off = integers(raw) - middle
        return off, (off - fraction) @ scaled

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, lines = np.zeros((kept, kept)), np.zeros(kept)
        for batch in batches:
            out = project(matrix(batch.column(0), dim))[1]
            products, lines = products + out.T @ out, lines + out.sum(axis=0)
        values = np.r_[products[_cells(kept)], lines]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], names=["at", "v"])

    parts = rows.select("vector").mapInArrow(add, "at int, v double")
    found = np.array([r.v for r in parts.groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()])
    products, means = found[:-kept] / n, found[-kept:] / n
    i, j = _cells(kept)
    error = float(np.abs(products - means[i] * means[j] - (i == j)).max())

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, out = project(matrix(batch.column(1), dim))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(_deviations(off, n, rest)),
                pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, kept), pa.int32()), pa.array(out.ravel())),
            ], names=["vec_id", "deviation", "z"])

    share = F.array(*[F.lit(float(v / trace)) for v in values[:kept]])
    laid = rows.mapInArrow(lay, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, deviation long, z array<double>")
    return laid.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


def _deviations(off: np.ndarray, n: int, rest: np.ndarray) -> np.ndarray:
    """Sum over dimensions of (n x - S)^2 per row, exact."""
    top = (float(np.abs(off).max(initial=0)) + 1) * n
    if top * top * off.shape[1] < 2.0 ** 62:
        apart = n * off - rest
        return (apart * apart).sum(axis=1)
    apart = n * off.astype(object) - rest.astype(object)
    wide = (apart * apart).sum(axis=1)
    if len(wide) and max(wide) >= 1 << 63:
        raise OverflowError("deviation exceeds a long")
    return wide.astype(np.int64)


def query(table: DataFrame) -> DataFrame:
    return whitened(table, "vec_id", "embedding")
