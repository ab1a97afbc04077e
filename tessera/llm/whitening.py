"""Whitened embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its triangular factor.

An entry c counts as the whole number floor(64 * c) + 1000000, so sums and deviations are exact. The mean and the scatter are
taken over the distinct vectors, which one shuffle finds; each task adds up its share, and only numbers per dimension or per
pair of dimensions meet: dimension by dimension in the driver, never a vector. The scatter S of the centred vectors is
factored as L L' with the largest remaining diagonal as pivot, L being lower triangular in the order of the pivots. Plane
rotations make the columns of L orthogonal without forming another product: since L J = U D, S is U D D U', so the squared
norms of the rotated columns over n are the eigenvalues and the columns over their norms the components.

Defined results. A row is left out if its vector is null or empty, or holds a null, a value that is not finite, or one of
2**56 and more in size. The dimension is the length that most distinct vectors have (the longer of two as common); rows of
another length are left out. Directions without variance have no component, so a table whose vectors are all equal, one
without vectors and an empty one give no rows. Repeated rows and rows that share a vec_id, null included, each give their own
rows. ``deviation`` is null from 9.2e18 on, where it does not fit. Columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.workspace import materialize

SCALE, SHIFT = 64.0, 1_000_000
#: Values of this size and more have no safe whole number.
TOO_LARGE = 2.0**56
#: How many components a row is projected on.
COMPONENTS = 16
#: A remaining diagonal below this part of the largest is rounding, not variance.
NO_VARIANCE = 1e-12
#: Columns count as orthogonal below this cosine; sweeps end well before the last one allowed.
ORTHOGONAL, SWEEPS = 1e-15, 60
#: Rows that a task holds as a dense block.
BLOCK_ROWS = 8192
#: A sum of squares from here on does not fit a long.
FULL_LONG = 9.2e18

Batches = Iterator[pa.RecordBatch]


def whole_vectors(batches: Batches) -> Batches:
    """``vec_id, x``: the whole numbers of each valid vector, as the bytes of 64-bit integers."""
    for batch in batches:
        vectors = batch.column("embedding")
        lengths = np.asarray(vectors.value_lengths().fill_null(0), np.int64)
        ends = np.cumsum(lengths)
        values = vectors.flatten()
        numbers = np.asarray(values.fill_null(float("nan")), np.float64)
        wrong = np.concatenate([[0], np.cumsum(~(np.abs(numbers) < TOO_LARGE))])
        kept = (lengths > 0) & (wrong[ends] == wrong[ends - lengths])
        data = (np.floor(SCALE * np.where(np.abs(numbers) < TOO_LARGE, numbers, 0.0)).astype(np.int64) + SHIFT).astype("<i8").tobytes()
        packed = [data[8 * (end - n) : 8 * end] for end, n in zip(ends[kept], lengths[kept], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id").filter(pa.array(kept)), pa.array(packed, pa.binary())], names=["vec_id", "x"])


def blocks(batches: Batches, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows with their whole numbers as a matrix, a bounded number at a time."""
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(first, BLOCK_ROWS)
            yield part, np.frombuffer(b"".join(part.column("x").to_pylist()), "<i8").reshape(-1, dim)


@dataclass(frozen=True)
class Centre:
    """The mean as a whole part and a rest, so that centring loses nothing to rounding."""

    n: int
    sums: list[int]

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([float(Fraction(s % self.n, self.n)) for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def deviations(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of (n x - sums)^2 per row, exact modulo 2**64, and whether it fits a long."""
        sums = np.array([s % (1 << 64) for s in self.sums], np.uint64)
        off = x.astype(np.uint64) * np.uint64(self.n) - sums
        exact = (off * off).sum(axis=1, dtype=np.uint64).astype(np.int64)
        near = ((self.centred(x) * self.n) ** 2).sum(axis=1)
        return exact, near < FULL_LONG


def sums_of(dim: int) -> Callable[[Batches], Batches]:
    """One row per task: rows and, per dimension, the sums of the high and the low halves, which no input overflows."""

    def add(batches: Batches) -> Batches:
        n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for part, x in blocks(batches, dim):
            n += part.num_rows
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"n": [n], "high": [high], "low": [low]})

    return add


def products_of(dim: int, rows: Callable[[np.ndarray], np.ndarray], width: int) -> Callable[[Batches], Batches]:
    """Per task and row i of the matrix R'R, R being ``rows`` of the task's vectors: i, the columns from i on, the sum of column i."""

    def add(batches: Batches) -> Batches:
        total, sums = np.zeros((width, width)), np.zeros(width)
        for _, x in blocks(batches, dim):
            r = rows(x)
            total += r.T @ r
            sums += r.sum(axis=0)
        yield pa.RecordBatch.from_pydict({"i": np.arange(width), "row": [total[i, i:] for i in range(width)], "total": sums})

    return add


def centre(fit: DataFrame, dim: int) -> Centre:
    halves = fit.mapInArrow(sums_of(dim), "n long, high array<long>, low array<long>")
    exact = "decimal(38,0)"
    found = (
        halves.select("n", F.posexplode(F.arrays_zip("high", "low")))
        .groupBy("pos")
        .agg(F.sum("n").alias("n"), F.sum(F.col("col.high").cast(exact)).alias("high"), F.sum(F.col("col.low").cast(exact)).alias("low"))
        .orderBy("pos")
        .collect()
    )
    return Centre(int(found[0]["n"]), [(int(r["high"]) << 32) + int(r["low"]) for r in found])


def products(fit: DataFrame, dim: int, rows: Callable[[np.ndarray], np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """R'R and the column sums of R over all tasks: as many numbers as pairs of columns, whatever the rows."""
    partial = fit.mapInArrow(products_of(dim, rows, width), "i long, row array<double>, total double")
    cells = partial.select("i", F.posexplode("row").alias("j", "value")).groupBy("i", "j").agg(F.sum("value").alias("value"))
    lines = cells.groupBy("i").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "value"))), lambda c: c["value"]).alias("row"))
    matrix = np.zeros((width, width))
    for r in lines.collect():
        matrix[r["i"], r["i"] :] = matrix[r["i"] :, r["i"]] = r["row"]
    sums = np.zeros(width)
    for r in partial.groupBy("i").agg(F.sum("total").alias("total")).collect():
        sums[r["i"]] = r["total"]
    return matrix, sums


def pivoted_cholesky(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L with scatter = L L', and the order of the pivots, in which L is lower triangular. L has a column per direction of variance."""
    dim = len(scatter)
    left = scatter.diagonal().copy()
    factor, order = np.zeros((dim, dim)), np.arange(dim)
    least = NO_VARIANCE * max(left.max(initial=0.0), 0.0)
    for k in range(dim):
        pivot = k + int(np.argmax(left[order[k:]]))
        if left[order[pivot]] <= least:
            return factor[:, :k], order
        order[[k, pivot]] = order[[pivot, k]]
        top, rest = order[k], order[k + 1 :]
        factor[top, k] = np.sqrt(left[top])
        factor[rest, k] = (scatter[rest, top] - factor[rest, :k] @ factor[top, :k]) / factor[top, k]
        left[rest] -= factor[rest, k] ** 2
    return factor, order


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The columns of ``factor``, rotated in pairs until all are orthogonal. A step turns disjoint pairs at once."""
    columns = factor.copy()
    width = columns.shape[1]
    ring = list(range(width)) + [-1] * (width % 2)
    half = len(ring) // 2
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(ring) - 1):
            pairs = [(a, b) for a, b in zip(ring[:half], ring[:half - 1:-1], strict=True) if a >= 0 and b >= 0]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            a, b = np.array(pairs, int).T if pairs else (np.zeros(0, int), np.zeros(0, int))
            left, right = columns[:, a], columns[:, b]
            aa, bb, ab = (left**2).sum(axis=0), (right**2).sum(axis=0), (left * right).sum(axis=0)
            cosine = np.abs(ab) / np.sqrt(aa * bb)
            worst = max(worst, cosine.max(initial=0.0))
            turn = cosine > ORTHOGONAL
            zeta = (bb - aa) / np.where(turn, 2 * ab, 1.0)
            tangent = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            cos = 1 / np.hypot(1.0, tangent)
            columns[:, a], columns[:, b] = cos * (left - tangent * right), cos * (tangent * left + right)
        if worst <= ORTHOGONAL * np.sqrt(len(factor)):
            break
    return columns


def spectrum(scatter: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the covariance, falling, and the components as columns."""
    factor, order = pivoted_cholesky(scatter)
    rotated = np.empty_like(factor)
    rotated[order] = one_sided_jacobi(factor[order])
    norms = np.sqrt((rotated**2).sum(axis=0))
    falling = np.argsort(-norms, kind="stable")
    return norms[falling] ** 2 / n, rotated[:, falling] / norms[falling]


@dataclass(frozen=True)
class Whitening:
    """A fitted model: rows of ``apply`` have unit covariance over the distinct vectors."""

    centre: Centre
    eigenvalues: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    identity_error: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.components / np.sqrt(self.eigenvalues)


def packed(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    return rows.mapInArrow(whole_vectors, "vec_id long, x binary")


def fitted(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The model of packed rows; None where no direction has variance."""
    fit = materialize(rows.select("x").distinct(), "distinct_vectors")
    size = F.octet_length("x")
    common = fit.groupBy(size.alias("bytes")).count().orderBy(F.desc("count"), F.desc("bytes")).first()
    if common is None:
        return None
    dim = common["bytes"] // 8
    fit = fit.filter(size == common["bytes"])
    mean = centre(fit, dim)
    scatter, _ = products(fit, dim, mean.centred, dim)
    values, axes = spectrum(scatter, mean.n)
    if not len(values):
        return None
    explained = values / (scatter.trace() / mean.n)
    model = Whitening(mean, values[:components], axes[:, :components], explained[:components], 0.0)
    squares, sums = products(fit, dim, model.apply, len(model.eigenvalues))
    covariance = squares / mean.n - np.outer(sums, sums) / mean.n**2
    error = float(np.abs(covariance - np.eye(len(covariance))).max())
    return Whitening(mean, model.eigenvalues, model.components, model.explained, error)


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def projected(model: Whitening) -> Callable[[Batches], Batches]:
    dim, k = model.components.shape

    def project(batches: Batches) -> Batches:
        for part, x in blocks(batches, dim):
            exact, fits = model.centre.deviations(x)
            rows = part.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.centre.n)),
                    pa.array(np.repeat(exact, k), mask=np.repeat(~fits, k)),
                    pa.array(model.apply(x).ravel()),
                    pa.array(np.tile(model.explained, rows)),
                    pa.array(np.full(rows * k, model.identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return project


def whitened(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """A row per valid vector and component; the table is read twice and only its distinct vectors are shuffled."""
    rows = packed(vectors, vec_id, embedding)
    model = fitted(rows, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], RESULT)
    return rows.filter(F.octet_length("x") == 8 * model.components.shape[0]).mapInArrow(projected(model), RESULT)
