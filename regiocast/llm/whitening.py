"""Embedding whitening by an incremental eigendecomposition.

Vectors become whole numbers, and each different one is fitted once.  Every
partition keeps the eigendecomposition of its scatter matrix and applies
centred rank-one updates to it: the poles and weights of the secular equation
are deflated, its roots are the new eigenvalues, and the new eigenvectors
follow from the roots (weights recomputed after Gu and Eisenstat, so they stay
orthogonal).  A block of more vectors than dimensions enters by the rows of
its triangular QR factor, which are as many rank-one terms as dimensions with
the same scatter.  Spectra of partitions are combined in rounds of at most
``FAN_IN`` by rank-one updates too: one for the shift between the means, one
per eigenpair.  Distributed Rayleigh-Ritz rounds over the fit list polish the
leading eigenvectors, and one more pass measures how far the whitened fit list
is from unit covariance.  Only matrices of the size of the dimension reach the
driver.

Cases: a NULL vector, or one with NULL, NaN, infinite or (times the scale) more
than 52-bit entries, is left out, as is one of another length than most (ties:
the longer); a NULL id stays an id; repeated rows are fitted once and each get
their output; components without variance (under ``NULL_SHARE`` of the largest
eigenvalue, so all of them for a single vector) are not returned; an empty
table gives no rows; other columns pass through, ones named like an output
column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from regiocast.session import remove_scratch, scratch_path

EPS = float(np.finfo(float).eps)
#: Vectors whose scatter is turned into one triangular factor.
BLOCK = 4096
#: Matrices that one task combines.
FAN_IN = 16
#: Rayleigh-Ritz rounds at most; one or two suffice.
ROUNDS = 4
#: Eigenvalues below this share of the largest count as none.
NULL_SHARE = 1e-11


def secular(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors (columns) of diag(d) + z z^T for strictly ascending d and z without zeros.

    Each root is sought from its nearer pole, so that differences to poles keep
    their relative precision: rational interpolation at both neighbouring poles,
    with bisection where that leaves the bracket.
    """
    m, zz = len(d), z * z
    top = zz.sum()
    gap = np.append(np.diff(d), top)
    half = gap / 2
    below = 1 + (zz / (d - d[:, None] - half[:, None])).sum(1) >= 0  # the root is in the lower half
    lo, hi = np.where(below, 0, -half), np.where(below, half, 0)
    if not below[-1]:  # above the last pole there is no other to start from
        lo[-1], hi[-1] = half[-1], top
    origin = np.arange(m) + np.where(below, 0, 1)
    origin[-1] = m - 1
    delta = d - d[origin][:, None]
    pole1 = np.diag(delta)
    pole2 = np.append(np.diag(delta, 1), top)
    left = np.tri(m, dtype=bool)
    x, done = (lo + hi) / 2, np.zeros(m, bool)
    with np.errstate(all="ignore"):
        for _ in range(200):
            t = delta - x[:, None]
            terms = zz / t
            f = 1 + terms.sum(1)
            done |= np.abs(f) <= 2 * EPS * m * (1 + np.abs(terms).sum(1))
            done |= hi - lo <= 2 * EPS * np.minimum(np.abs(lo), np.abs(hi))
            if done.all():
                break
            slopes = terms / t
            psi = np.where(left, slopes, 0).sum(1)
            phi = slopes.sum(1) - psi
            lo, hi = np.where(f < 0, x, lo), np.where(f < 0, hi, x)
            d1, d2 = pole1 - x, pole2 - x
            c = f - d1 * psi - d2 * phi
            a, b = (d1 + d2) * f - d1 * d2 * (psi + phi), d1 * d2 * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = d1[-1] + d1[-1] ** 2 * psi[-1] / c[-1]
            new = x + step
            new = np.where(np.isfinite(new) & (new > lo) & (new < hi), new, (lo + hi) / 2)
            x = np.where(done, x, new)
    away = delta - x[:, None]  # d_j less root i
    i, j = np.arange(m - 1)[:, None], np.arange(m)[None, :]
    below_root = np.where(i < j, d[:-1, None], d[1:, None]) - d[None, :]
    weights = np.sqrt(np.prod(-away[:-1] / below_root, axis=0) * -away[-1]) * np.sign(z)
    vectors = weights / away
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    return d[origin] + x, vectors.T


def rank_one(values: np.ndarray, vectors: np.ndarray, u: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigendecomposition of (vectors diag(values) vectors^T + rho u u^T), values ascending, rho >= 0."""
    z = vectors.T @ u * np.sqrt(rho)
    tol = 8 * EPS * max(np.abs(values).max(initial=0), float(z @ z))
    values, vectors = values.copy(), vectors.copy()
    norm = np.sqrt(z @ z)
    live = np.flatnonzero(np.abs(z) * norm > tol)  # a weight that changes nothing keeps its eigenpair
    if not len(live):
        return values, vectors

    def close(p, q):
        r = np.hypot(z[p], z[q])
        return (values[q] - values[p]) * np.abs(z[p] / r * z[q] / r) <= tol

    if len(live) > 1 and close(live[:-1], live[1:]).any():
        kept = [live[0]]
        for q in live[1:]:  # poles that coincide: turn the pair until one weight is zero
            p = kept[-1]
            if close(p, q):
                r = np.hypot(z[p], z[q])
                c, s = z[q] / r, z[p] / r
                vp, vq = vectors[:, p].copy(), vectors[:, q].copy()
                vectors[:, p], vectors[:, q] = c * vp - s * vq, s * vp + c * vq
                values[p], values[q] = c * c * values[p] + s * s * values[q], s * s * values[p] + c * c * values[q]
                z[p], z[q] = 0, r
                kept[-1] = q
            else:
                kept.append(q)
        live = np.array(kept)
        live = live[np.argsort(values[live], kind="stable")]
    values[live], turned = secular(values[live], z[live])
    vectors[:, live] = vectors[:, live] @ turned
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Mean and eigendecomposition of the scatter matrix (sum of squares about the mean) of ``n`` vectors."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dims: int) -> Spectrum:
        return cls(0, np.zeros(dims), np.zeros(dims), np.eye(dims))

    def _term(self, u: np.ndarray, rho: float) -> None:
        self.values, self.vectors = rank_one(self.values, self.vectors, u, rho)

    def _moved(self, n: int, mean: np.ndarray) -> None:
        """The scatter between the means of what is here and ``n`` more vectors."""
        if self.n:
            self._term(mean - self.mean, self.n * n / (self.n + n))
        self.mean = self.mean + (mean - self.mean) * (n / (self.n + n))
        self.n += n

    def add(self, rows: np.ndarray) -> None:
        """More vectors: one centred update each, or of a large block one per row of its triangular factor."""
        if len(rows) <= len(self.mean):
            for row in rows:
                self._moved(1, row)
            return
        mean = rows.mean(0)
        for term in np.linalg.qr(rows - mean, mode="r"):
            self._term(term, 1.0)
        self._moved(len(rows), mean)

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self._term(vector, float(value))
        self._moved(other.n, other.mean)

    def packed(self) -> np.ndarray:
        return np.concatenate([[float(self.n)], self.mean, self.values, self.vectors.ravel()])

    @classmethod
    def unpacked(cls, cells: np.ndarray, dims: int) -> Spectrum:
        mean, values, vectors = np.split(cells[1:], [dims, 2 * dims])
        return cls(int(cells[0]), mean, values, vectors.reshape(dims, dims))


@dataclass
class Whitening:
    """A fitted transformation: ``components`` are the columns of unit eigenvectors by falling eigenvalue."""

    dims: int
    n: int
    sums: list[int]  # per dimension, exact
    scale: float
    offset: int
    components: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    eigenvalues: np.ndarray = field(default_factory=lambda: np.zeros(0))
    explained: np.ndarray = field(default_factory=lambda: np.zeros(0))
    residual: float = 0.0
    identity_error: float = 0.0

    def scaled_deviation(self, x: np.ndarray) -> np.ndarray:
        """n * x - sum per dimension, exact; whole numbers beyond 63 bits as Python's."""
        origin = [s // self.n for s in self.sums]
        rest = [s - self.n * o for s, o in zip(self.sums, origin, strict=True)]
        shifted = x - np.array(origin, np.int64)
        if len(x) and float(np.abs(shifted).max(initial=0)) * self.n < 2.0**62:
            return shifted * np.int64(self.n) - np.array(rest, np.int64)
        return shifted.astype(object) * self.n - np.array(rest, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled_deviation(x).astype(float) / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.eigenvalues)

    def deviation(self, x: np.ndarray) -> list[int]:
        v = self.scaled_deviation(x)
        if v.dtype == object or float(np.abs(v).max(initial=0)) ** 2 * max(self.dims, 1) >= 2.0**62:
            v = v.astype(object)
        return [int(s) for s in (v * v).sum(1)]  # Arrow refuses what leaves 64 bits


def whole_numbers(vector: Column, scale: float, offset: int) -> Column:
    """floor(scale * entry) + offset as longs; NULL for a vector that has no such form."""
    scaled = F.transform(vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")) + F.lit(offset))
    odd = F.exists(vector, lambda c: c.isNull() | ~(F.abs(F.lit(float(scale)) * c.cast("double")) < F.lit(2.0**52)) | F.isnan(c.cast("double")))
    return F.when(vector.isNotNull() & ~odd, scaled)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def _folded(df: DataFrame, start: Callable[[], object], add: Callable, pack: Callable, merge: Callable) -> np.ndarray | None:
    """One array from all partitions: each folds its batches, then rounds of ``FAN_IN`` packed arrays a task."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, seen = start(), False
        for batch in batches:
            if batch.num_rows:
                state, seen = add(state, batch.column(0)), True
        if seen:
            yield pa.record_batch([pa.array([pack(state).tobytes()], pa.binary())], names=["cells"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for cells in batch.column(0):
                one = np.frombuffer(cells.as_py())
                total = one if total is None else merge(total, one)
        if total is not None:
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["cells"])

    parts = df.mapInArrow(first, "cells binary")
    left = df.rdd.getNumPartitions()
    while left > 1:
        left = -(-left // FAN_IN)
        parts = parts.repartition(left).mapInArrow(again, "cells binary")
    row = parts.first()
    return None if row is None else np.frombuffer(row.cells)


def _exact_sums(fit_list: DataFrame, dims: int) -> tuple[int, list[int]]:
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            if len(x):  # under 2^53 times the rows of a batch
                yield pa.record_batch([pa.array(range(-1, dims), pa.int32()), pa.array([len(x), *x.sum(0).tolist()], pa.int64())], names=["dim", "s"])

    rows = fit_list.mapInArrow(partial, "dim int, s long").groupBy("dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    sums = {r.dim: int(r.s) for r in rows}  # a row per dimension
    return sums.pop(-1, 0), [sums[k] for k in sorted(sums)]


def _dimension(vectors: DataFrame) -> int:
    found = vectors.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    return found.dims if found else 0


def fit(df: DataFrame, vector_col: str = "embedding", components: int = 16, scale: float = 64.0, offset: int = 1_000_000) -> Whitening:
    """The transformation of all different vectors of ``df``."""
    spark = df.sparkSession
    vectors = df.select(whole_numbers(F.col(vector_col), scale, offset).alias("x")).where("x IS NOT NULL")
    dims = _dimension(vectors)
    if not dims:
        return Whitening(0, 0, [], scale, offset)
    path = scratch_path(spark, "whitening")
    vectors.where(F.size("x") == dims).distinct().write.parquet(path)
    try:
        return _fitted(spark.read.parquet(path), dims, components, scale, offset)
    finally:
        remove_scratch(spark, path)


def _fitted(fit_list: DataFrame, dims: int, components: int, scale: float, offset: int) -> Whitening:
    n, sums = _exact_sums(fit_list, dims)
    model = Whitening(dims, n, sums, scale, offset)
    origin = np.array([s // n for s in sums], np.int64)

    def add(state: Spectrum, column: pa.Array) -> Spectrum:
        x = (_matrix(column, dims) - origin).astype(float)
        for at in range(0, len(x), BLOCK):
            state.add(x[at : at + BLOCK])
        return state

    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        one = Spectrum.unpacked(a, dims)
        one.merge(Spectrum.unpacked(b, dims))
        return one.packed()

    spectrum = Spectrum.unpacked(_folded(fit_list, lambda: Spectrum.empty(dims), add, Spectrum.packed, merge), dims)
    _refine(fit_list, model, spectrum.vectors[:, ::-1], components)
    model.explained = model.eigenvalues / _trace(spectrum)
    kept = model.eigenvalues > NULL_SHARE * max(model.eigenvalues.max(initial=0), 0)
    model.eigenvalues, model.components, model.explained = model.eigenvalues[kept], model.components[:, kept], model.explained[kept]
    if kept.any():
        model.identity_error = _identity_error(fit_list, model)
    return model


def _trace(spectrum: Spectrum) -> float:
    return float(spectrum.values.sum() / spectrum.n) or 1.0


def _refine(fit_list: DataFrame, model: Whitening, vectors: np.ndarray, components: int) -> None:
    """Rayleigh-Ritz: the covariance on twice the wanted vectors, and on their residuals while these are not rounding error."""
    dims, wanted, best = model.dims, min(components, model.dims), np.inf
    basis = np.linalg.qr(vectors[:, : 2 * wanted])[0]
    for _ in range(ROUNDS):

        def add(state: np.ndarray, column: pa.Array, basis: np.ndarray = basis) -> np.ndarray:
            y = model.centred(_matrix(column, dims))
            return state + y.T @ (y @ basis)

        image = _folded(fit_list, lambda basis=basis: np.zeros(basis.shape), add, np.ravel, np.add).reshape(basis.shape) / model.n
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz = basis @ turn
        rest = image @ turn - ritz * values
        residual = float(np.linalg.norm(rest[:, :wanted], axis=0).max())
        if residual < best:
            best = residual
            model.eigenvalues, model.components, model.residual = values[:wanted], ritz[:, :wanted], residual
        if residual <= 16 * EPS * max(values[0], 0) or residual > best or basis.shape[1] == dims:
            return
        more = np.linalg.qr(np.hstack([ritz, rest[:, :wanted]]))[0]
        basis = more[:, : min(dims, more.shape[1])]


def _identity_error(fit_list: DataFrame, model: Whitening) -> float:
    k = len(model.eigenvalues)

    def add(state: np.ndarray, column: pa.Array) -> np.ndarray:
        z = model.whiten(_matrix(column, model.dims))
        return state + np.vstack([z.T @ z, z.sum(0)])

    total = _folded(fit_list, lambda: np.zeros((k + 1, k)), add, np.ravel, np.add).reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten(df: DataFrame, model: Whitening, vector_col: str = "embedding") -> DataFrame:
    """The rows of ``df`` with a vector of the model's dimension, plus ``deviation`` long and ``whitened`` array<double>."""

    @arrow_udf("struct<deviation: long, whitened: array<double>>")
    def project(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = _matrix(batch, model.dims)
            rows = model.whiten(x)
            whitened = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * rows.shape[1], pa.array(rows.ravel()))
            yield pa.StructArray.from_arrays([pa.array(model.deviation(x), pa.int64()), whitened], ["deviation", "whitened"])

    others = df.drop("deviation", "whitened", "__llm_x", "__llm_z")
    if not model.n or not len(model.eigenvalues):
        return others.where(F.lit(False)).withColumns({"deviation": F.lit(None).cast("long"), "whitened": F.lit(None).cast("array<double>")})
    placed = others.withColumn("__llm_x", whole_numbers(F.col(vector_col), model.scale, model.offset))
    placed = placed.where(F.col("__llm_x").isNotNull() & (F.size("__llm_x") == model.dims))
    placed = placed.withColumn("__llm_z", project("__llm_x"))
    return placed.withColumns({"deviation": F.col("__llm_z.deviation"), "whitened": F.col("__llm_z.whitened")}).drop("__llm_x", "__llm_z")
