"""Embedding whitening with components found by FEAST contour integration.

Each entry c becomes the whole number x = floor(64 c) + 1000000. Sums, and products of entries less the whole part
of their mean, are added up as exact whole numbers in the tasks; what the mean has beyond its whole part leaves the
products exactly too, so the covariance is that of centred vectors, rounded once. The driver holds sums per
dimension and per pair of dimensions, whatever the number of rows.

The largest eigenvalues are then found without a full decomposition. The covariance is reduced to a
tridiagonal matrix, whose inertia at a shift (Sturm's count of negative pivots) tells how many eigenvalues lie
beneath it; bisection by such counts cuts the wanted ones into disjoint intervals. Each interval is a Spark task:
quadrature over a circle through its ends, with a solve of the complex shifted covariance per node, projects a random
block onto the interval's eigenvectors; Rayleigh-Ritz extracts them, and the block is projected again, and widened where that is
too slow, until the residuals are those of rounding. An interval must give as many components as inertia counts in it, else the run
fails: none is missed. Eigenvalues that are equal up to rounding share an interval.

Vectors that are null, or hold a null or non-finite entry or one of 2^46 or more, take no part. Neither do empty
ones, nor vectors of another length than the most frequent one (the longer one, if two are as frequent). Repeated rows count
each. Components are as many as dimensions, `most` at best; one without variance (at most 1e-12 of the largest, or
one row only) has `explained` zero and `whitened` null, and plays no part in `identity_error`. `deviation` is null where
it is no long. No rows are left: no result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewrank.llm.common import in_batches

SCALE, OFFSET = 64, 1_000_000
# Eigenvalues that one contour may enclose, and the columns of a block above them.
PER_INTERVAL, SPARE = 8, 8
NODES = 8  # of the quadrature on half a circle; the other half is its mirror
ROUNDS = 20
STEEPEST = 100  # times that the upper end of an interval is larger than the lower
LARGEST = 2**46  # of an entry's size; 64 times that is exact as a double
EXACT = 2**53  # whole numbers up to here are exact as doubles
NO_VARIANCE = 1e-12


# Rows to sums


def _vectors(embeddings: DataFrame) -> DataFrame:
    """`vec_id, embedding` of the rows that take part, whatever their length."""
    usable = F.forall("embedding", lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    return embeddings.select("vec_id", "embedding").filter((F.size("embedding") > 0) & usable)


def _frequent_length(vectors: DataFrame) -> int | None:
    lengths = vectors.groupBy(F.size("embedding").alias("length")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return first and first["length"]


def _whole(rows: pa.RecordBatch, length: int) -> np.ndarray:
    """x of each row, as whole doubles without the offset."""
    entries = rows.column("embedding").flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * entries.astype(np.float64)).reshape(rows.num_rows, length)


def _exact_product(z: np.ndarray) -> np.ndarray:
    """Sums of products of whole numbers, exact, as Python's."""
    if len(z) * float(np.abs(z).max(initial=0)) ** 2 < EXACT:
        return (z.T @ z).astype(np.int64).astype(object)
    whole = z.astype(np.int64).astype(object)
    return whole.T @ whole


def _added_up(vectors: DataFrame, length: int, shift: list[int] | None) -> list[int]:
    """Row number and sums of x - offset; with a shift, the sums of products of x - offset - shift instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for rows in batches:
            z = _whole(rows, length)
            if shift is None:
                sums = z.astype(np.int64).astype(object).sum(axis=0) if rows.num_rows else [0] * length
                total = total + np.array([rows.num_rows, *sums], dtype=object)
            else:
                z -= np.array(shift, dtype=np.float64)
                sums = z.astype(np.int64).astype(object).sum(axis=0)
                total = total + np.concatenate([sums, _exact_product(z).ravel()])
        if isinstance(total, np.ndarray):
            values = pa.array(map(Decimal, total.tolist()), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), values], names=["place", "value"])

    parts = in_batches(vectors.select("embedding"), run, "place bigint, value decimal(38,0)")
    sums = parts.groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect()
    return [int(row["value"]) for row in sums]


# Eigenvalues by counting, eigenvectors by contours


def _tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared side diagonal of a similar tridiagonal matrix, by reflections."""
    a = matrix.copy()
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        size = v @ v
        if size == 0:
            continue
        a[k + 1 :, :] -= np.outer(v, 2 / size * (v @ a[k + 1 :, :]))
        a[:, k + 1 :] -= np.outer(2 / size * (a[:, k + 1 :] @ v), v)
    return np.diag(a).copy(), np.diag(a, 1) ** 2


class Inertia:
    """How many eigenvalues of a symmetric matrix lie at or above a shift."""

    def __init__(self, matrix: np.ndarray):
        self.diagonal, self.sides = _tridiagonal(matrix)
        self.tiny = np.finfo(float).tiny / np.finfo(float).eps * max(1.0, self.sides.max(initial=0))

    def above(self, shift: float) -> int:
        pivot, negative = self.diagonal[0] - shift, 0
        negative += pivot < 0
        for d, side in zip(self.diagonal[1:], self.sides, strict=True):
            if abs(pivot) < self.tiny:
                pivot = -self.tiny
            pivot = d - shift - side / pivot
            negative += pivot < 0
        return len(self.diagonal) - int(negative)


def _cut(inertia: Inertia, low: float, high: float, wanted: int, width: float) -> float:
    """A shift with `wanted` eigenvalues above, or the nearest one beneath a cluster that holds the border.

    Bisects on, so that the shift lies in a gap and not beside an eigenvalue.
    """
    bottom = low
    while high - low > width:
        middle = (low + high) / 2
        if inertia.above(middle) == wanted:
            return _widest(inertia, low, middle, high, wanted, width)
        low, high = (middle, high) if inertia.above(middle) > wanted else (low, middle)
    return _widest(inertia, bottom, low, low, inertia.above(low), width)


def _widest(inertia: Inertia, low: float, middle: float, high: float, wanted: int, width: float) -> float:
    """The middle of the gap around a shift, to an eighth of its size."""

    def edge(inside: float, outside: float) -> float:
        while abs(outside - inside) > max(abs(middle - inside) / 8, width):
            probe = (inside + outside) / 2
            inside, outside = (probe, outside) if inertia.above(probe) == wanted else (inside, probe)
        return inside

    return (edge(middle, low) + edge(middle, high)) / 2


def intervals(matrix: np.ndarray, most: int) -> list[tuple[float, float, int]]:
    """Disjoint intervals that hold the `most` largest eigenvalues, with their counts: `low, high, count`."""
    inertia = Inertia(matrix)
    radius = np.abs(matrix).sum(axis=1).max()  # no eigenvalue is larger
    top, width = radius * (1 + 1e-9) + np.finfo(float).tiny, 1e-13 * radius
    bottom, found, out = -top, 0, []
    most = min(most, len(matrix))
    while found < most:
        low = _cut(inertia, bottom, top, min(found + PER_INTERVAL, most), width)
        # Eigenvalues of very different size look alike to a contour around the largest of them.
        step = top / STEEPEST
        if step > max(low, width):
            above = inertia.above(step)
            low = step if above == found else _widest(inertia, max(low, width), step, top, above, width)
        above = inertia.above(low)
        if above > found:
            out.append((low, top, above - found))
        top, found = low, above
    return out


def components(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The `count` eigenvalues in an interval, falling, and their unit eigenvectors as columns."""
    size = len(matrix)
    middle, half = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(0.5j * np.pi * (1 - points))
    shifted = (middle + half * turns)[:, None, None] * np.eye(size) - matrix
    scale = np.abs(matrix).sum(axis=1).max()
    columns = count + SPARE
    while True:
        columns = min(size, columns)
        block = np.random.default_rng(size).standard_normal((size, columns))
        for _ in range(ROUNDS):
            solved = np.linalg.solve(shifted, block.astype(complex)[None])
            block = np.einsum("n,nij->ij", weights * half * turns / 2, solved).real
            # The filter leaves directions outside all but empty; scaled columns keep them from rounding.
            block, _ = np.linalg.qr(block / np.maximum(np.linalg.norm(block, axis=0), np.finfo(float).tiny))
            values, turn = np.linalg.eigh(block.T @ matrix @ block)
            block = block @ turn
            inside = np.flatnonzero((values >= low) & (values <= high))[::-1]
            found = block[:, inside]
            residual = np.linalg.norm(matrix @ found - found * values[inside], axis=0).max(initial=0)
            if len(inside) == count and residual <= 4e-15 * size * scale:
                return values[inside], found
        if columns == size:
            raise RuntimeError(f"{len(inside)} of {count} components from {low} to {high}, residual {residual:.1e}")
        columns *= 2  # too many eigenvalues close outside the contour


def refined(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz over the vectors of all intervals, which makes them orthogonal across intervals too."""
    block, _ = np.linalg.qr(vectors)
    values, turn = np.linalg.eigh(block.T @ matrix @ block)
    return values[::-1], (block @ turn)[:, ::-1]


def _eigen(embeddings: DataFrame, covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their vectors as rows: one task for each interval."""
    parts = intervals(covariance, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for number in rows.column("id").to_pylist():
                values, vectors = components(covariance, *parts[number])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))], names=["value", "vector"]
                )

    numbers = embeddings.sparkSession.range(0, len(parts), 1, len(parts))
    found = sorted(in_batches(numbers, run, "value double, vector array<double>").collect(), reverse=True)
    values, vectors = refined(covariance, np.array([row["vector"] for row in found]).T)
    return values[:most], vectors.T[:most]


# Whitened rows


def _whitened(rows: pa.RecordBatch, mean: np.ndarray, axes: np.ndarray) -> np.ndarray:
    return (_whole(rows, len(mean)) - mean) @ axes.T


def _identity_error(vectors: DataFrame, mean: np.ndarray, axes: np.ndarray, n: int) -> float:
    """Largest entry of the covariance of whitened rows minus the identity."""
    if not len(axes):
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(axes) + 1, len(axes)))
        for rows in batches:
            w = _whitened(rows, mean, axes)
            total[0] += w.sum(axis=0)
            total[1:] += w.T @ w
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["place", "value"]
        )

    parts = in_batches(vectors.select("embedding"), run, "place bigint, value double")
    sums = parts.groupBy("place").agg(F.sum("value").alias("value")).orderBy("place").collect()
    total = np.array([row["value"] for row in sums]).reshape(-1, len(axes)) / n
    # Rows are centred before they are multiplied; what rounding left of their mean goes here.
    covariance = total[1:] - np.outer(total[0], total[0])
    return float(np.abs(covariance - np.eye(len(axes))).max())


def _deviations(whole: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; null beyond a long."""
    own = np.array(sums, dtype=object)
    largest = n * (float(np.abs(whole).max(initial=0)) + max(abs(s) / n for s in sums))
    if len(sums) * largest**2 < 2**62:
        return ((n * whole.astype(np.int64) - own.astype(np.int64)) ** 2).sum(axis=1).tolist()
    exact = ((n * whole.astype(np.int64).astype(object) - own) ** 2).sum(axis=1).tolist()
    return [value if value < 2**63 else None for value in exact]


def whiten(embeddings: DataFrame, most: int = 32) -> DataFrame:
    """`vec_id, component, n, deviation, whitened, explained, identity_error`, a row per vector and component."""
    schema = (
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
        "identity_error double"
    )
    usable = _vectors(embeddings)
    length = _frequent_length(usable)
    if not length:
        return embeddings.sparkSession.createDataFrame([], schema)
    vectors = usable.filter(F.size("embedding") == length)
    n, *sums = _added_up(vectors, length, None)
    shift = [s // n for s in sums]
    added = _added_up(vectors, length, shift)
    rest, products = added[:length], added[length:]
    entries = [
        (n * products[i * length + j] - rest[i] * rest[j]) / (n * n) for i in range(length) for j in range(length)
    ]
    covariance = np.array(entries, dtype=np.float64).reshape(length, length)
    mean = np.array([s + r / n for s, r in zip(shift, rest, strict=True)])
    trace = float(np.trace(covariance))
    values, directions = (np.zeros(min(most, length)), np.zeros((min(most, length), length)))
    if trace > 0:
        values, directions = _eigen(embeddings, covariance, most)
    real = values > NO_VARIANCE * values.max()
    explained = np.where(real, values / trace if trace > 0 else 0.0, 0.0)
    axes = directions[real] / np.sqrt(values[real])[:, None]
    error = _identity_error(vectors, mean, axes, n)
    count = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = np.full((rows.num_rows, count), np.nan)
            out[:, real] = _whitened(rows, mean, axes)
            columns = {
                "vec_id": pa.array(rows.column("vec_id").to_pylist(), pa.int64()).take(
                    pa.array(np.repeat(np.arange(rows.num_rows), count))
                ),
                "component": pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows.num_rows)),
                "n": pa.array(np.full(out.size, n)),
                "deviation": pa.array(_deviations(_whole(rows, length), n, sums), pa.int64()).take(
                    pa.array(np.repeat(np.arange(rows.num_rows), count))
                ),
                "whitened": pa.array(out.ravel(), mask=np.tile(~real, rows.num_rows)),
                "explained": pa.array(np.tile(explained, rows.num_rows)),
                "identity_error": pa.array(np.full(out.size, error)),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return in_batches(vectors, run, schema)
