"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

1. Every entry c of a vector becomes the whole number floor(scale * c). The *fit list* has each distinct
   vector of whole numbers once; it is written, since three passes read it.
2. Sums of the fit list are exact. A second pass adds up the scatter of the centred vectors, task by task.
3. The scatter, a matrix of dims x dims whatever the number of rows, is factored on the driver as
   P A P' = L L' by Cholesky with diagonal pivots. Plane rotations from the right then make the columns of
   L orthogonal (one-sided Jacobi): their squared lengths are the eigenvalues of the scatter, and the
   normalised columns, with the rows put back in order, are the components. No product L'L is formed.
4. A third pass measures the covariance of the whitened fit list; the rows themselves are projected last.
"""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from martflow.llm.common import written

SCALE = 256
COMPONENTS = 4
#: The driver and every task hold one matrix of this many rows and columns at most (32 MiB).
MAX_DIMS = 2_048
#: Rows whose vectors are worked on at once.
_ROWS = 4_096
#: Scaled entries from here on have no 64-bit whole number to spare.
_LIMIT = 2.0**62


class Whitening(NamedTuple):
    """What the fit list gives: n vectors of ``dims`` entries, their sums, components and eigenvalues."""

    n: int
    sums: list[int]
    components: np.ndarray  # dims x k, columns of unit length
    values: np.ndarray  # k eigenvalues of the covariance, falling
    trace: float
    scale: float

    @property
    def dims(self) -> int:
        return len(self.sums)

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def projection(self) -> np.ndarray:
        """Takes centred vectors to whitened ones; columns without variance give NaN."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scaled = self.components / np.sqrt(self.values)
        return np.where(self.values > 0, scaled, np.nan)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.projection

    def deviation(self, x: np.ndarray) -> list[int]:
        """For each row the exact sum of (n * x - S) ** 2."""
        sums = np.array(self.sums, object)
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        exact = x.astype(object) if most * most * max(1, self.dims) >= 1 << 63 else x
        away = self.n * exact - (sums if exact.dtype == object else sums.astype(np.int64))
        return [int(v) for v in (away * away).sum(axis=1)]


def whole_vectors(column: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The scaled entries of all vectors in a row, the length of each, and which vectors are usable."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = column.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(entries * scale)
        bad = ~(np.abs(scaled) < _LIMIT)
    row = np.repeat(np.arange(len(sizes)), sizes)
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (np.bincount(row[bad], minlength=len(sizes)) == 0)
    return np.where(bad, 0, scaled).astype(np.int64), sizes, usable


def _of_size(entries: np.ndarray, sizes: np.ndarray, usable: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The usable vectors of one length as a matrix, and their rows."""
    chosen = usable & (sizes == dims)
    rows = np.flatnonzero(chosen)
    return entries[np.repeat(chosen, sizes)].reshape(len(rows), dims), rows


def _packed(x: np.ndarray) -> list[bytes]:
    """Each row as bytes: the width of its entries, then these; equal rows have equal bytes."""
    reach = np.maximum(x.max(axis=1, initial=0), ~x.min(axis=1, initial=0))
    widths = np.select([reach < 1 << 7, reach < 1 << 15, reach < 1 << 31], [1, 2, 4], 8)
    out: list[bytes] = [b""] * len(x)
    for width in np.unique(widths).tolist():
        for row in np.flatnonzero(widths == width).tolist():
            out[row] = bytes([width]) + x[row].astype(f"<i{width}").tobytes()
    return out


def _unpacked(column: pa.Array, dims: int) -> np.ndarray:
    """The rows of ``_packed`` again."""
    x = np.empty((len(column), dims), np.int64)
    for k, value in enumerate(column.to_pylist()):
        x[k] = np.frombuffer(value, f"<i{value[0]}", offset=1)
    return x


def _chunks(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            yield batch.slice(start, _ROWS)


def _distinct_vectors(df: DataFrame, vector: str, scale: float) -> DataFrame:
    """(dims, x) once for each distinct usable vector, x packed."""

    def pack(batches):
        for batch in _chunks(batches):
            entries, sizes, usable = whole_vectors(batch.column(0), scale)
            for dims in np.unique(sizes[usable]).tolist():
                x = list(dict.fromkeys(_packed(_of_size(entries, sizes, usable, dims)[0])))
                yield pa.RecordBatch.from_arrays([pa.array([dims] * len(x), pa.int32()), pa.array(x, pa.binary())], names=["dims", "x"])

    return df.select(vector).mapInArrow(pack, "dims int, x binary").distinct()


def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """The number of vectors, and the exact sum of each entry."""

    def add(batches):
        n, total = 0, np.zeros(dims, object)
        for batch in _chunks(batches):
            x = _unpacked(batch.column("x"), dims)
            n += len(x)
            safe = int(np.abs(x).max(initial=0)) < (1 << 62) // _ROWS
            total += (x if safe else x.astype(object)).sum(axis=0).astype(object)
        if n:
            values = [Decimal(int(v)) for v in (n, *total)]
            yield pa.RecordBatch.from_arrays([pa.array(range(dims + 1), pa.int32()), pa.array(values, pa.decimal128(38, 0))], names=["at", "s"])

    added = fit.select("x").mapInArrow(add, "at int, s decimal(38,0)").groupBy("at").agg(F.sum("s").cast("decimal(38,0)").alias("s"))
    found = {r["at"]: int(r["s"]) for r in added.collect()}
    return found[0], [found[k + 1] for k in range(dims)]


def _scatter(fit: DataFrame, mean: np.ndarray) -> np.ndarray:
    """Sum of the outer products of the centred vectors."""
    dims = len(mean)
    upper = np.triu_indices(dims)

    def add(batches):
        total, seen = np.zeros((dims, dims)), False
        for batch in _chunks(batches):
            centred = _unpacked(batch.column("x"), dims) - mean
            total += centred.T @ centred
            seen = True
        if seen:
            cells = total[upper]
            for start in range(0, len(cells), 100_000):
                part = cells[start : start + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(start, start + len(part))), pa.array(part)], names=["at", "s"])

    rows = fit.select("x").mapInArrow(add, "at bigint, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()
    cells = np.zeros(len(upper[0]))
    for r in rows:
        cells[r["at"]] = r["s"]
    out = np.zeros((dims, dims))
    out[upper] = cells
    return out + np.triu(out, 1).T


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A lower trapezoidal factor L and an order of the rows with matrix[order][:, order] = L L'.

    L has as many columns as the matrix has rank; what is left then is smaller than rounding.
    """
    left = np.array(matrix, float)
    size = len(left)
    order = np.arange(size)
    factor = np.zeros((size, size))
    least = size * np.finfo(float).eps * max(left.diagonal().max(initial=0.0), 0.0)
    for k in range(size):
        pivot = k + int(np.argmax(left.diagonal()[k:]))
        if not left[pivot, pivot] > least:
            return factor[:, :k], order
        for rows in (left, factor, order):
            rows[[k, pivot]] = rows[[pivot, k]]
        left[:, [k, pivot]] = left[:, [pivot, k]]
        factor[k, k] = np.sqrt(left[k, k])
        factor[k + 1 :, k] = left[k + 1 :, k] / factor[k, k]
        left[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def _rounds(size: int):
    """Every pair of ``size`` columns once, as rounds of disjoint pairs (a tournament)."""
    players = list(range(size + size % 2))
    for _ in range(len(players) - 1):
        half = len(players) // 2
        pairs = [(a, b) for a, b in zip(players[:half], reversed(players[half:])) if max(a, b) < size]
        yield np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)
        players = [players[0], players[-1], *players[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor after plane rotations from the right that make its columns orthogonal."""
    columns = np.array(factor, float)
    size = columns.shape[1]
    rounds = list(_rounds(size)) if size > 1 else []
    tiny = np.finfo(float).eps * max(1, len(columns)) ** 0.5
    for _ in range(sweeps):
        turned = False
        for left, right in rounds:
            a, b = columns[:, left], columns[:, right]
            alpha, beta, gamma = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            turn = np.abs(gamma) > tiny * np.sqrt(alpha * beta)
            if not turn.any():
                continue
            turned = True
            left, right, a, b = left[turn], right[turn], a[:, turn], b[:, turn]
            zeta = (beta[turn] - alpha[turn]) / (2 * gamma[turn])
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            s = c * t
            columns[:, left], columns[:, right] = c * a - s * b, s * a + c * b
        if not turned:
            break
    return columns


def eigen_pairs(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a positive semidefinite matrix, falling, and unit eigenvectors as columns, up to its rank."""
    factor, order = pivoted_cholesky(scatter)
    columns = one_sided_jacobi(factor)
    norms = np.sqrt((columns * columns).sum(axis=0))
    falling = np.argsort(-norms, kind="stable")
    vectors = np.empty_like(columns)
    vectors[order] = columns / norms
    return norms[falling] ** 2, vectors[:, falling]


def fit_whitening(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: float = SCALE) -> tuple[Whitening | None, DataFrame]:
    """The model, None without usable vectors, and the written fit list that it was learned from."""
    fit = written(_distinct_vectors(df, vector, scale), "whitening-fit")
    most = fit.where("dims > 0").groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    if most is None:
        return None, fit
    dims = most["dims"]
    if dims > MAX_DIMS:
        raise ValueError(f"vectors have {dims} entries; the scatter matrix is bounded to {MAX_DIMS}")
    fit = fit.where(F.col("dims") == dims)
    n, sums = _sums(fit, dims)
    mean = np.array([s / n for s in sums])
    scatter = _scatter(fit, mean)
    values, vectors = eigen_pairs(scatter)
    k = min(components, dims)
    rank = min(k, len(values))
    chosen = np.zeros((dims, k))
    chosen[:, :rank] = vectors[:, :rank]
    kept = np.zeros(k)
    kept[:rank] = values[:rank] / n
    return Whitening(n, sums, chosen, kept, float(np.trace(scatter)) / n, scale), fit


def identity_error(model: Whitening, fit: DataFrame) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity; None without variance."""
    live = np.flatnonzero(model.values > 0).tolist()
    if not live:
        return None

    def project(batches):
        for batch in _chunks(batches):
            w = model.whitened(_unpacked(batch.column("x"), model.dims))
            yield pa.RecordBatch.from_arrays([pa.array(w[:, k]) for k in live], names=[f"w{k}" for k in live])

    rows = fit.select("x").mapInArrow(project, ", ".join(f"w{k} double" for k in live))
    pairs = [(i, j) for i in live for j in live if i <= j]
    found = rows.agg(*(F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: float = SCALE) -> DataFrame:
    """Adds to each row with a usable vector: whitened and explained (arrays of up to ``components`` values),
    deviation (decimal, exact), n, identity_error.

    Rows whose vector is null or has null or non-finite entries go, and so do those with entries too large for
    64-bit whole numbers. Repeated rows all stay; each distinct vector counts once in the fit. If lengths differ, the
    most frequent one among distinct vectors (the longer of equally frequent ones) is fitted, and rows of other
    lengths, or with no entries, stay with nulls in the new columns. A component without variance is explained 0, its
    whitened value is null, and identity_error looks at the others (null if there are none). Other columns
    pass through, whatever their names; those named like the new ones are replaced. A table without usable vectors
    gives rows of nulls for empty vectors only. More than MAX_DIMS entries raise an error.
    """
    model, fit = fit_whitening(df, vector, components, scale)
    new = T.StructType.fromDDL("whitened array<double>, explained array<double>, deviation decimal(38,0), n bigint, identity_error double")
    kept = [c for c in df.columns if c not in new.names]
    source = df if vector in kept else df.withColumn("__vector", F.col(vector))
    column = vector if vector in kept else "__vector"
    kinds = {f.name: to_arrow_type(f.dataType) for f in new}
    error = identity_error(model, fit) if model else None
    explained = [float(v / model.trace) if model.trace else 0.0 for v in model.values] if model else []

    def project(batches):
        for batch in _chunks(batches):
            entries, sizes, usable = whole_vectors(batch.column(column), scale)
            made: dict[str, list] = {name: [None] * batch.num_rows for name in kinds}
            if model:
                x, rows = _of_size(entries, sizes, usable, model.dims)
                w = model.whitened(x)
                for k, row in enumerate(rows.tolist()):
                    made["whitened"][row] = [None if np.isnan(v) else v for v in w[k].tolist()]
                    made["explained"][row], made["n"][row], made["identity_error"][row] = explained, model.n, error
                for row, value in zip(rows.tolist(), model.deviation(x)):
                    made["deviation"][row] = value
            arrays = [pa.array(made[name], kind) for name, kind in kinds.items()]
            found = pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *arrays], names=[*kept, *kinds])
            yield found.filter(pa.array(usable))

    return source.mapInArrow(project, T.StructType([*(f for f in df.schema if f.name in kept), *new]))
