"""Embedding whitening: principal components by spectral divide and conquer, then a broadcast projection.

The covariance is summed exactly, in whole numbers, over all vectors. Its eigenvectors come from polar decompositions:
the polar factor of the covariance shifted by s has eigenvalues +1 and -1, so half of it plus the identity projects on
the invariant subspace of the eigenvalues above s; both subspaces are split again until they are lines. The QDWH
iteration finds the polar factor with QR factorisations and Cholesky solves alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from inkwell.llm.common import map_arrow, read

COMPONENTS = 8
SCALE, LIFT = 1024, 100_000
# Larger entries could make the exact sums of 10^11 vectors overflow 38 digits; they count as not finite.
LARGEST = 2.0 ** 34
EPS = np.finfo(float).eps


# ---- eigenvectors of one symmetric matrix ----

def polar(matrix: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by the dynamically weighted Halley iteration (QDWH)."""
    size = len(matrix)
    eye = np.eye(size)
    x = matrix / max(np.linalg.norm(matrix), np.finfo(float).tiny)
    low = EPS  # lower bound of the singular values; if some are below it, those take a few more steps
    for _ in range(40):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = math.sqrt(1 + d)
        a = root + 0.5 * math.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root)))
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        if c > 100:  # early steps: stable for badly conditioned iterates
            q = np.linalg.qr(np.vstack([math.sqrt(c) * x, eye]))[0]
            new = b / c * x + (a - b / c) / math.sqrt(c) * (q[:size] @ q[size:].T)
        else:
            factor = np.linalg.cholesky(eye + c * (x.T @ x))
            half = np.linalg.solve(factor, x.T)
            new = b / c * x + (a - b / c) * np.linalg.solve(factor.T, half).T
        new = (new + new.T) / 2
        low = min(1.0, low * (a + b * square) / (1 + c * square))
        moved, x = np.linalg.norm(new - x), new
        if low >= 1 - 1e-15 and moved < 100 * EPS * math.sqrt(size):
            break
    return x


def _subspaces(matrix: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the invariant subspaces above and below ``shift``; None where the shift does not part them cleanly."""
    size = len(matrix)
    projector = (polar(matrix - shift * np.eye(size)) + np.eye(size)) / 2
    rank = round(np.trace(projector))
    if not 0 < rank < size or np.linalg.norm(projector @ projector - projector) > 1e-8:
        return None
    basis = projector @ rng.standard_normal((size, rank))
    for _ in range(2):
        basis = projector @ np.linalg.qr(basis)[0]
    whole = np.linalg.qr(basis, mode="complete")[0]
    above, below = whole[:, :rank], whole[:, rank:]
    return (above, below) if np.linalg.norm(below.T @ matrix @ above) <= 1e-12 * np.linalg.norm(matrix) * size else None


def _split(matrix: np.ndarray, least: float, rng: np.random.Generator) -> np.ndarray:
    """Orthogonal matrix whose columns span the lines (or inseparable clusters) of ``matrix``."""
    size = len(matrix)
    middle = np.trace(matrix) / size
    if size == 1 or np.linalg.norm(matrix - middle * np.eye(size)) <= least:
        return np.eye(size)
    diagonal = np.sort(np.diag(matrix))
    gaps = [(diagonal[i] + diagonal[i + 1]) / 2 for i in np.argsort(np.diff(diagonal))[::-1][:8]]
    for shift in (float(np.median(diagonal)), middle, *gaps):
        parts = _subspaces(matrix, shift, rng)
        if parts is not None:
            made = []
            for basis in parts:
                inner = basis.T @ matrix @ basis
                made.append(basis @ _split((inner + inner.T) / 2, least, rng))
            return np.hstack(made)
    # no shift parts it: a cluster tighter than the arithmetic can tell; turn one plane and go on
    turn = np.linalg.qr(rng.standard_normal((size, size)))[0]
    inner = turn.T @ matrix @ turn
    return turn @ _split((inner + inner.T) / 2, max(least * 10, EPS * np.linalg.norm(matrix)), rng)


def _polish(matrix: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """One step of simultaneous refinement: takes errors of eigenvectors to their squares, clusters stay as they are."""
    overlap = np.eye(len(matrix)) - vectors.T @ vectors
    turned = vectors.T @ matrix @ vectors
    turned = (turned + turned.T) / 2
    values = np.diag(turned) / (1 - np.diag(overlap))
    apart = values[None, :] - values[:, None]
    tight = 1e-10 * np.abs(values).max(initial=0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        step = np.where(np.abs(apart) > tight, (turned + values[None, :] * overlap) / apart, overlap / 2)
    np.fill_diagonal(step, np.diag(overlap) / 2)
    return vectors + vectors @ step


def components_of(matrix: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix by spectral divide and conquer.

    Signs: the largest entry of each vector is positive. A matrix of size 0 gives empty arrays.
    """
    matrix = (matrix + matrix.T) / 2
    size = len(matrix)
    if not size:
        return np.zeros(0), np.zeros((0, 0))
    vectors = _split(matrix, size * EPS * np.linalg.norm(matrix), np.random.default_rng(seed))
    for _ in range(2):
        vectors = _polish(matrix, vectors)
    vectors /= np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, matrix @ vectors)
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(size)])
    return values[order], vectors * np.where(signs == 0, 1, signs)


# ---- statistics over all vectors ----

def whole_numbers(batch: pa.RecordBatch, column: int, size: int) -> np.ndarray:
    """x of a batch's vectors: a matrix of 64-bit whole numbers."""
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * values).astype(np.int64).reshape(-1, size) + LIFT


def vectors_of(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vector) without null vectors and those with null, non-finite or too large entries."""
    vector = F.col(vec_col)
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return rows.where(vector.isNotNull() & fine & (F.size(vector) > 0)).select(
        F.col(id_col).alias("id_"), vector.cast("array<double>").alias("vector_"))


def _dimension(vectors: DataFrame) -> int:
    """The most frequent length, of several the largest; 0 without vectors."""
    size = F.size("vector_").alias("size")
    top = vectors.groupBy(size).count().orderBy(F.desc("count"), F.desc("size")).first()
    return top["size"] if top else 0


def sums_of(vectors: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of x in each dimension."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = whole_numbers(batch, 0, size)
        return pa.RecordBatch.from_arrays(
            [pa.array(range(size + 1), pa.int32()), pa.array([len(x), *x.sum(0).tolist()], pa.int64())], names=["i", "s"])

    parts = map_arrow(vectors.select("vector_"), run, "i int, s long", rows=10_000)
    total = dict(parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    return int(total[0]), [int(total[i]) for i in range(1, size + 1)]


def _exact_products(y: np.ndarray) -> np.ndarray:
    """y^T y of whole numbers, exact, as Python integers: matrix products of pieces that floating point holds exactly."""
    largest = int(np.abs(y).max(initial=0))
    if largest * largest >= 2 ** 53:
        y = y.astype(object)
        return y.T @ y
    total = np.zeros((y.shape[1],) * 2, object)
    rows = max(1, 2 ** 53 // max(1, largest * largest))
    for start in range(0, len(y), rows):
        piece = y[start:start + rows].astype(np.float64)
        total += (piece.T @ piece).astype(np.int64).astype(object)
    return total


def covariance_of(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance of x with divisor n. Every vector is centred on the rounded mean before multiplying, so the sums of
    products are whole and the same whatever the order of tasks; what rounding left of the mean is then taken off."""
    size = len(sums)
    mid = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    above, right = np.triu_indices(size)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = _exact_products(whole_numbers(batch, 0, size) - mid)[above, right]
        return pa.RecordBatch.from_arrays(
            [pa.array(above, pa.int32()), pa.array(right, pa.int32()), pa.array([int(v) for v in made], pa.decimal128(38, 0))],
            names=["i", "j", "v"])

    parts = map_arrow(vectors.select("vector_"), run, "i int, j int, v decimal(38,0)", rows=10_000)
    out = np.zeros((size, size))
    for i, j, v in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # one row for each pair of dimensions
        left = (sums[i] - n * int(mid[i])) * (sums[j] - n * int(mid[j]))
        out[i, j] = out[j, i] = float((int(v) * n - left) / (n * n))
    return out


class Whitener:
    """Mean, components and scales: small arrays that tasks get with the function."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, components: int):
        self.n, self.sums = n, sums
        values, vectors = components_of(covariance)
        trace = float(np.trace(covariance))
        self.values, self.axes = values[:components], vectors[:, :components]
        self.explained = [float(v / trace) if trace else None for v in self.values]
        #: components without variance cannot be scaled to one
        self.spread = self.values > len(covariance) * EPS * max(trace, 0.0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exact: 64-bit where that holds it, Python integers elsewhere."""
        bound = self.n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, self.sums), default=0)
        if bound < 2 ** 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        scale = np.where(self.spread, np.sqrt(np.where(self.spread, self.values, 1)), np.nan)
        return (centred / self.n).astype(np.float64) @ self.axes / scale


def _deviations(centred: np.ndarray) -> list[int | None]:
    """Sums of squares, exact; None beyond 64 bits."""
    largest = int(np.abs(centred).max(initial=0))
    if largest * largest * max(1, centred.shape[1]) < 2 ** 63:
        return (centred * centred).sum(1).tolist()
    exact = (centred.astype(object) ** 2).sum(1).tolist()
    return [int(v) if v < 2 ** 63 else None for v in exact]


def identity_error(vectors: DataFrame, whitener: Whitener) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, from the vectors themselves;
    components without variance are left out. None if none is left."""
    size, wide = len(whitener.sums), int(whitener.spread.sum())
    if not wide:
        return None
    above, right = np.triu_indices(wide + 1)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = whitener.whitened(whitener.centred(whole_numbers(batch, 0, size)))[:, whitener.spread]
        w = np.hstack([np.ones((len(w), 1)), w])  # the first column's products are the sums
        return pa.RecordBatch.from_arrays(
            [pa.array(above, pa.int32()), pa.array(right, pa.int32()), pa.array((w.T @ w)[above, right])], names=["i", "j", "v"])

    # w is centred by the exact mean of x, so its own mean is rounding alone and is taken off here
    parts = map_arrow(vectors.select("vector_"), run, "i int, j int, v double", rows=10_000)
    found = {(i, j): v / whitener.n for i, j, v in parts.groupBy("i", "j").agg(F.sum("v")).collect()}
    return max(abs(v - found[0, i] * found[0, j] - (i == j)) for (i, j), v in found.items() if i)


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) per vector and component.

    x is floor(1024 c) + 100000 of an entry c. Vectors that are null, empty, or hold null or non-finite entries or
    such of 2^34 and more are left out, and so are those of another length than the most frequent one (ties: the
    longest). Repeated vectors and ids, and null ids, are rows like any other. Fewer dimensions than ``components`` give
    fewer rows. Equal eigenvalues give some orthogonal vectors of their space, the same for all rows. A component
    without variance has whitened null, and identity_error leaves it out; explained is null if nothing varies.
    deviation is null beyond 64 bits. Other columns are ignored; no vectors, no rows. The driver gets one number for
    each pair of dimensions, and every task the mean and ``components`` axes.
    """
    vectors = vectors_of(rows, id_col, vec_col)
    size = _dimension(vectors)
    schema = (f"id_ {dict(vectors.dtypes)['id_']}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    vectors = vectors.where(F.size("vector_") == size)
    if size:
        n, sums = sums_of(vectors, size)
        whitener = Whitener(n, sums, covariance_of(vectors, n, sums), components)
        error = identity_error(vectors, whitener)
    else:
        whitener, error = Whitener(0, [], np.zeros((0, 0)), components), None
    wide = len(whitener.values)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        count = batch.num_rows
        centred = whitener.centred(whole_numbers(batch, 1, size))
        made = whitener.whitened(centred)
        again = pa.array(np.repeat(np.arange(count), wide))
        return pa.RecordBatch.from_arrays([
            batch.column(0).take(again),
            pa.array(np.tile(np.arange(1, wide + 1, dtype=np.int32), count)),
            pa.array(np.full(count * wide, whitener.n, np.int64)),
            pa.array(_deviations(centred), pa.int64()).take(again),
            pa.array(made.reshape(-1), pa.float64(), from_pandas=True),
            pa.array(whitener.explained * count, pa.float64()),
            pa.array([error] * (count * wide), pa.float64()),
        ], names=["id_", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_arrow(vectors, run, schema, rows=4096).withColumnRenamed("id_", id_col)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of every embedding."""
    return whiten(read(spark, sf_dir, "embeddings"))
