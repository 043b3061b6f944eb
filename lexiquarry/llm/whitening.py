"""Whitening of embeddings by shifted CholeskyQR.

1. Vectors become whole numbers on a grid, so that counts and sums are exact. One pass adds them up.
2. The centred rows A are made orthogonal without being collected: a pass sums the Gram matrix of the rows in each
   task, then block by block; its Cholesky factor R1 (of the matrix plus a shift, as it may not be definite in
   floating point) turns the rows into A R1^-1 by a triangular solve inside the tasks of the next pass, whose Gram
   matrix gives R2, and so on until it is the identity. Then A = Q R with R = ... R2 R1.
3. The singular values and right vectors of R are those of A, without the squared condition of a covariance matrix. They
   give variances and components.
4. One more pass measures how far the covariance of the whitened rows is from the identity.

The driver holds matrices of the vectors' dimension, never rows.

Defined results: rows whose vector is null or empty, holds null or non-finite components, or a component that is no
64-bit integer on the grid, take no part; neither do vectors of another length than most have (of two
lengths equally frequent, the greater one counts). Rows of one id, or with a null id, are vectors of their own. Components
without variance (a standard deviation below 1e-14 of the largest for each dimension) cannot be whitened and are left out, so a
table of equal vectors and an empty table give an empty result. A deviation beyond 64 bits is null.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRID = 64
OFFSET = 1_000_000
COMPONENTS = 32
MAX_PASSES = 10
SLICE = 4096
LIMIT = 1 << 63
_HALF = 31


@dataclass(frozen=True)
class Grid:
    """The whole number of a component c is floor(scale * c) + offset."""

    scale: int = GRID
    offset: int = OFFSET

    def usable(self, vectors: pa.Array, dim: int | None) -> np.ndarray:
        """True for the rows that take part; without `dim`, whatever their length."""
        sizes = np.array(pc.fill_null(pc.list_value_length(vectors), 0))
        bounds = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=bounds[1:])
        flat = self._flat(vectors)
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(self.scale * flat)
            good = np.isfinite(flat) & (np.abs(x) < LIMIT - 2 * abs(self.offset) - 2048)
        bad = np.zeros(len(flat) + 1, np.int64)
        np.cumsum(~good, out=bad[1:])
        ok = (sizes > 0) & (bad[bounds[1:]] == bad[bounds[:-1]])
        return ok if dim is None else ok & (sizes == dim)

    @staticmethod
    def _flat(vectors: pa.Array) -> np.ndarray:
        return np.array(pc.fill_null(vectors.flatten().cast(pa.float64()), np.nan))

    def numbers(self, vectors: pa.Array, dim: int) -> np.ndarray:
        """Matrix of the whole numbers of rows that are all usable."""
        return np.floor(self.scale * self._flat(vectors)).astype(np.int64).reshape(-1, dim) + self.offset


@dataclass(frozen=True)
class Sums:
    """Number of rows, and exact sums of each dimension."""

    n: int
    totals: tuple[int, ...]

    @property
    def dim(self) -> int:
        return len(self.totals)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x minus the means; the whole part of a mean is taken off exactly."""
        whole = np.array([t // self.n for t in self.totals], np.int64)
        return (x - whole).astype(np.float64) - np.array([(t % self.n) / self.n for t in self.totals])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - total)**2 for each row, exactly; None where it has over 63 bits."""
        whole = np.array([t // self.n for t in self.totals], np.int64)
        rest = [t % self.n for t in self.totals]
        apart = x - whole
        largest = max(abs(int(apart.min(initial=0))), abs(int(apart.max(initial=0)))) + 1
        if (self.n * largest) ** 2 * self.dim < LIMIT:
            d = self.n * apart - np.array(rest, np.int64)
            return (d * d).sum(axis=1).tolist()
        d = self.n * apart.astype(object) - np.array(rest, object)
        return [int(v) if v < LIMIT else None for v in (d * d).sum(axis=1)]


@dataclass(frozen=True)
class Whitening:
    """Fitted on `sums`; whitened rows are centred rows times `weights`, one column a component."""

    grid: Grid
    sums: Sums
    weights: np.ndarray
    explained: np.ndarray
    identity_error: float


def _batches(rows: DataFrame, grid: Grid, dim: int, work: Callable[[np.ndarray], None],
             result: Callable[[], Iterator[tuple[int, np.ndarray]]], kind: np.dtype) -> dict[int, np.ndarray]:
    """Arrays by block number: `work` sees the numbers of all rows of a task, `result` gives its blocks, and equal blocks are
    added where they meet. As many numbers as all blocks have come to the driver."""
    schema = "block int, part binary"

    def pack(blocks: Iterator[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        found = list(blocks)
        return pa.record_batch([pa.array([i for i, _ in found], pa.int32()),
                                pa.array([b.tobytes() for _, b in found], pa.binary())], ["block", "part"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(0)
            for at in range(0, len(vectors), SLICE):
                part = vectors.slice(at, SLICE)
                part = part.filter(pa.array(grid.usable(part, dim)))
                if len(part):
                    work(grid.numbers(part, dim))
        yield pack(result())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(raw.as_buffer(), kind)
                total[i] = total[i] + part if i in total else part.copy()
        yield pack(iter(total.items()))

    summed = rows.mapInArrow(gather, schema).repartition("block").mapInArrow(add, schema).toArrow()
    return {i: np.frombuffer(raw, kind) for i, raw in zip(summed["block"].to_pylist(), summed["part"].to_pylist(), strict=True)}


def _common_length(rows: DataFrame, grid: Grid) -> int:
    """The length of most usable vectors, 0 without any."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(0).filter(pa.array(grid.usable(batch.column(0), None)))
            dims, n = np.unique(np.array(pc.list_value_length(vectors)), return_counts=True)
            yield pa.record_batch([pa.array(dims, pa.int32()), pa.array(n, pa.int64())], ["dim", "n"])

    most = (rows.mapInArrow(count, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), F.desc("dim")).first())
    return most.dim if most else 0


def _sums(rows: DataFrame, grid: Grid, dim: int) -> Sums:
    """High and low halves of the numbers are added apart, so no sum leaves 64 bits."""
    total = np.zeros((3, dim), np.int64)

    def work(x: np.ndarray) -> None:
        total[0] += len(x)
        total[1] += (x >> _HALF).sum(axis=0)
        total[2] += (x & ((1 << _HALF) - 1)).sum(axis=0)

    found = _batches(rows, grid, dim, work, lambda: iter([(0, total)]), np.dtype(np.int64))
    n, high, low = found[0].reshape(3, dim)
    return Sums(int(n[0]), tuple((int(h) << _HALF) + int(v) for h, v in zip(high, low, strict=True)))


def _gram(rows: DataFrame, grid: Grid, sums: Sums, change: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over all rows of the products of change(centred rows), summed by blocks of matrix rows."""
    total = np.zeros((width, width))
    step = max(1, (1 << 20) // max(width, 1))

    def work(x: np.ndarray) -> None:
        q = change(sums.centred(x))
        total[:] += q.T @ q

    def blocks() -> Iterator[tuple[int, np.ndarray]]:
        return ((at, total[at:at + step]) for at in range(0, width, step))

    found = _batches(rows, grid, sums.dim, work, blocks, np.dtype(np.float64))
    return np.concatenate([found[at] for at in range(0, width, step)]).reshape(width, width)


def solve_rows(factors: list[np.ndarray], a: np.ndarray) -> np.ndarray:
    """Rows a R1^-1 R2^-1 ... for upper triangular factors: blocks of columns from the left, column by column."""
    for r in factors:
        q = np.empty_like(a)
        for first in range(0, len(r), 64):
            last = min(first + 64, len(r))
            rest = a[:, first:last] - q[:, :first] @ r[:first, first:last]
            for j in range(first, last):
                q[:, j] = (rest[:, j - first] - q[:, first:j] @ r[first:j, j]) / r[j, j]
        a = q
    return a


def _upper_factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Cholesky factor R with R^T R = gram, plus a shift where it is asked for or where there is none without."""
    d = len(gram)
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * np.linalg.norm(gram, 2)
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 10


def _orthogonal(gram: np.ndarray) -> bool:
    """True for an identity, but for directions without any variance."""
    values = np.linalg.eigvalsh(gram)
    return bool(np.all((np.abs(values - 1) < 1e-13 * len(gram)) | (np.abs(values) < 1e-12)))


def fit_whitening(embeddings: DataFrame, vector: str = "embedding", grid: Grid = Grid(),
                  components: int | None = COMPONENTS) -> Whitening | None:
    """Components of all usable rows, by falling variance; None without any."""
    rows = embeddings.select(F.col(vector).cast("array<double>").alias("v"))
    dim = _common_length(rows, grid)
    if not dim:
        return None
    sums = _sums(rows, grid, dim)
    factors: list[np.ndarray] = []
    r = np.eye(dim)
    for _ in range(MAX_PASSES):
        held = list(factors)
        gram = _gram(rows, grid, sums, lambda a, held=held: solve_rows(held, a), dim)
        if not gram.any() or (factors and _orthogonal(gram)):
            break
        factors.append(_upper_factor(gram, sums.n, shifted=not factors))
        r = factors[-1] @ r
    if not factors:
        return None
    _, deviation, axes = np.linalg.svd(r)
    kept = int((deviation > deviation[0] * dim * 1e-14).sum())
    kept = kept if components is None else min(components, kept)
    variance = deviation**2 / sums.n
    weights = axes[:kept].T / np.sqrt(variance[:kept])
    covariance = _gram(rows, grid, sums, lambda a: a @ weights, kept) / sums.n
    return Whitening(grid, sums, weights, variance[:kept] / variance.sum(), float(np.abs(covariance - np.eye(kept)).max()))


def whiten(embeddings: DataFrame, fitted: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of every usable row and component."""
    schema = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = embeddings.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        k = model.weights.shape[1]
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                part = part.filter(pa.array(model.grid.usable(part.column(1), model.sums.dim)))
                n = part.num_rows
                if not n:
                    continue
                x = model.grid.numbers(part.column(1), model.sums.dim)
                whitened = model.sums.centred(x) @ model.weights
                each = pa.array(np.repeat(np.arange(n), k))
                yield pa.record_batch([
                    part.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                    pa.array(np.full(n * k, model.sums.n)), pa.array(model.sums.deviations(x), pa.int64()).take(each),
                    pa.array(whitened.ravel()), pa.array(np.tile(model.explained, n)),
                    pa.array(np.full(n * k, model.identity_error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    if fitted is None:
        return embeddings.sparkSession.createDataFrame([], schema).withColumnRenamed("id", key)
    held = embeddings.sparkSession.sparkContext.broadcast(fitted)  # matrices of the vectors' dimension
    return rows.mapInArrow(work, schema).withColumnRenamed("id", key)
