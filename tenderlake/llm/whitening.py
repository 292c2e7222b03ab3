"""Embedding whitening: principal axes by Chebyshev-filtered subspace iteration over distributed passes.

Vectors are quantised to whole numbers, ``floor(256 * c)``, so that sums, counts and squared
deviations are exact.  The covariance V is that of the distinct quantised vectors, centred before
multiplying, with their number as divisor; it is never formed.

* A pass computes ``V Q`` for a narrow matrix Q: each task multiplies its centred rows,
  ``Xᵀ(X Q)``, and returns one matrix of dimension x width; Spark adds them by row of the matrix.
* A Chebyshev polynomial of V, applied to the subspace by its three-term recurrence (one pass a degree),
  keeps the unwanted part of the spectrum, [0, smallest Ritz value], within [-1, 1] and enlarges what
  lies above it.  No bound from above is needed as the wanted end is the upper one.
* QR on the driver (dimension x width numbers), one pass, and Rayleigh-Ritz give new axes.  They are certified when
  the residual ``|V q - e q|`` of each wanted pair is less than ``TOLERANCE`` of the largest eigenvalue.

Defined results: rows whose vector is null or holds a null, NaN or infinite entry are dropped;
so are vectors whose length is not the most frequent one among the rest (of equally frequent ones the
longest counts).  Repeated rows are returned as often as they occur, but count once in the fit.  Axes
without variance (eigenvalue below 1e-12 of the trace) can't be whitened: they have no rows, so that one
distinct vector, empty vectors and an empty table give none.  Equal eigenvalues: any basis of
their space, the same for all rows.  A squared deviation beyond the range of a long is null.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_columns, ship, written

SCALE = 256
#: Columns of the subspace beyond the wanted ones, degree of the polynomial, and filter rounds at most.
GUARD = 12
DEGREE = 8
ROUNDS = 60
#: A residual relative to the largest eigenvalue at which an axis is certified.
TOLERANCE = 2e-14
#: Least share of the trace with which an axis counts.
LEAST = 1e-12


def quantised(vectors: pa.Array, length: int | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """(places, vectors of whole numbers) of the usable vectors of a list column, of one length only if it is given."""
    if not len(vectors):
        return np.empty(0, np.int64), []
    sizes = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.cast(vectors.flatten(), pa.float64()).to_numpy(zero_copy_only=False)  # null entries become NaN
    ends = np.cumsum(np.maximum(sizes, 0))
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    begin = ends - np.maximum(sizes, 0)
    good = (sizes >= 0) & (bad[ends] == bad[begin])
    if length is not None:
        good &= sizes == length
    places = np.flatnonzero(good)
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.clip(np.floor(SCALE * np.nan_to_num(flat)), -2.0**62, 2.0**62).astype(np.int64)
    return places, [whole[begin[i]:ends[i]] for i in places]


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    """The rows of a column of 64-bit whole numbers in bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), length)


def _parts(x: np.ndarray, rows: int = 4096) -> Iterator[np.ndarray]:
    for i in range(0, len(x), rows):
        yield x[i:i + rows]


@dataclass
class Fit:
    """What whitening needs of a set of distinct vectors."""

    length: int
    n: int
    sums: list[int]
    axes: np.ndarray       # length x components
    values: np.ndarray     # their eigenvalues
    trace: float
    residuals: np.ndarray  # of the axes, as a share of the largest eigenvalue
    passes: int
    certified: bool
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) @ self.axes) / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*x - S)^2, exactly."""
        sums = np.array(self.sums, object)
        top = max(int(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums), default=0))
        if self.length * (2 * top) ** 2 < 2**63:
            d = self.n * x - sums.astype(np.int64)
            return (d * d).sum(axis=1).tolist()
        exact = [int(((self.n * row.astype(object) - sums) ** 2).sum()) for row in x]
        return [e if e < 2**63 else None for e in exact]


def _most_frequent_length(vectors: DataFrame) -> int:
    def make():
        def f(batch: pa.RecordBatch) -> dict:
            sizes, counts = np.unique([len(v) for v in quantised(batch.column(0))[1]], return_counts=True)
            return {"length": sizes.astype(np.int64), "n": counts.astype(np.int64)}
        return f

    found = (map_columns(vectors, "length bigint, n bigint", make).groupBy("length").agg(F.sum("n").alias("n"))
             .orderBy(F.col("n").desc(), F.col("length").desc()).first())
    return found["length"] if found else 0


def distinct_vectors(vectors: DataFrame, length: int) -> DataFrame:
    """The written fit list: each distinct quantised vector once, as bytes (x)."""
    def make():
        def f(batch: pa.RecordBatch) -> dict:
            return {"x": [v.astype("<i8").tobytes() for v in quantised(batch.column(0), length)[1]]}
        return f

    return written(map_columns(vectors, "x binary", make).distinct(), "vectors")


def _sums(fit: DataFrame, length: int) -> tuple[int, list[int]]:
    """(number of vectors, exact sum of each dimension)."""
    def make():
        def f(batch: pa.RecordBatch) -> dict:
            x = _matrix(batch.column(0), length)
            # Halves of each number, so that a task's sums can't overflow.
            low, high = (x & 0xFFFFFFFF).sum(axis=0), (x >> 32).sum(axis=0)
            return {"dim": np.arange(-1, length), "low": np.append([len(x)], low), "high": np.append([0], high)}
        return f

    rows = (map_columns(fit, "dim int, low bigint, high bigint", make).groupBy("dim")
            .agg(F.sum(F.col("low").cast("decimal(38,0)")).alias("low"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high")).collect())
    total = {r["dim"]: int(r["low"]) + (int(r["high"]) << 32) for r in rows}
    return total.get(-1, 0), [total.get(i, 0) for i in range(length)]


def added(fit: DataFrame, make_part, width: int) -> np.ndarray:
    """The sum over all rows of the matrices ``make_part(x)`` of rows x ``width``: one for each batch, added in its
    task, then by matrix row on the cluster."""
    spark = fit.sparkSession
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = make_part(batch.column(0))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)), pa.int32())] + [pa.array(total[:, j], pa.float64()) for j in range(width)],
                names=["row", *[f"c{j}" for j in range(width)]])

    ddl = ", ".join(["row int", *[f"c{j} double" for j in range(width)]])
    rows = (fit.mapInArrow(run, ddl).groupBy("row").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(width)]).collect())
    out = np.zeros((max((r["row"] for r in rows), default=-1) + 1, width))
    for r in rows:
        out[r["row"]] = r[1:]
    return out


class Covariance:
    """V of the fit list as an operator: ``times(Q)`` is one distributed pass."""

    def __init__(self, fit: DataFrame, n: int, sums: list[int]):
        self.fit, self.n, self.sums, self.passes = fit, n, sums, 0
        self.mean = np.array([s / n for s in sums])

    def times(self, q: np.ndarray) -> np.ndarray:
        self.passes += 1
        mean, length = self.mean, len(self.sums)

        def part(column: pa.Array) -> np.ndarray:
            total = 0
            for x in _parts(_matrix(column, length)):
                centred = x - mean
                total = total + centred.T @ (centred @ q)
            return total

        return added(self.fit, part, q.shape[1]) / self.n

    def trace(self) -> float:
        mean, length = self.mean, len(self.sums)

        def part(column: pa.Array) -> np.ndarray:
            return sum(((x - mean) ** 2).sum(axis=0) for x in _parts(_matrix(column, length)))[:, None]

        return float(added(self.fit, part, 1).sum() / self.n)


def chebyshev(times, q: np.ndarray, vq: np.ndarray, cut: float, top: float, degree: int) -> np.ndarray:
    """The polynomial of degree ``degree`` that is small on [0, cut], applied to ``q``; ``vq`` is ``times(q)``.
    Scaled by its value at ``top`` in every step, so that nothing overflows."""
    half = cut / 2
    sigma = half / (top - half)
    first = sigma
    before, now = q, (vq - half * q) * (sigma / half)
    for _ in range(degree - 1):
        new = 1 / (2 / first - sigma)
        before, now = now, (2 * new / half) * (times(now) - half * now) - sigma * new * before
        sigma = new
    return now


def leading_axes(times, length: int, trace: float, wanted: int, guard: int = GUARD, degree: int = DEGREE,
                 rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """(eigenvalues, axes, residuals, certified) of the ``wanted`` largest eigenvalues of a symmetric
    positive semidefinite operator ``times``.

    After certification one more round is made and the pairs with the smaller residuals stay.  Where rounding
    keeps the residuals above ``TOLERANCE``, the rounds end when three in a row bring no progress."""
    width = min(length, wanted + guard)
    q = np.linalg.qr(np.random.default_rng(7).standard_normal((length, width)))[0]
    best, stale, sure = None, 0, False
    for _ in range(rounds):
        vq = times(q)
        theta, u = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        theta, u = theta[::-1], u[:, ::-1]
        q, vq = q @ u, vq @ u
        top = theta[0]
        if top <= LEAST * trace:
            return np.empty(0), np.empty((length, 0)), np.empty(0), True
        errors = np.linalg.norm(vq - q * theta, axis=0)[:wanted] / top
        if best is None or errors.max() < best[2].max():
            stale = 0 if best is None or errors.max() < best[2].max() / 2 else stale + 1
            best = theta[:wanted].copy(), q[:, :wanted].copy(), errors
        else:
            stale += 1
        if width == length or sure or stale >= 3:
            break
        sure = best[2].max() <= TOLERANCE
        cut = max(float(theta[-1]), LEAST * top)
        if cut >= top * (1 - 1e-9):  # all Ritz values alike: nothing to damp
            break
        q = np.linalg.qr(chebyshev(times, q, vq, cut, top, degree))[0]
    values, axes, errors = best
    keep = values > LEAST * trace
    return values[keep], axes[:, keep], errors[keep], bool(errors[keep].max(initial=0) <= TOLERANCE)


def fit_axes(vectors: DataFrame, components: int = 4) -> Fit | None:
    """Principal axes of the distinct quantised vectors of a one-column table; None without vectors of some length."""
    length = _most_frequent_length(vectors)
    if not length:
        return None
    fit = distinct_vectors(vectors, length)
    n, sums = _sums(fit, length)
    covariance = Covariance(fit, n, sums)
    trace = covariance.trace()
    if not trace > 0:
        return Fit(length, n, sums, np.empty((length, 0)), np.empty(0), 0.0, np.empty(0), 0, True)
    values, axes, errors, sure = leading_axes(covariance.times, length, trace, min(components, length))
    got = Fit(length, n, sums, axes, values, trace, errors, covariance.passes, sure)
    width = len(values)

    def part(column: pa.Array) -> np.ndarray:
        total = np.zeros((width + 1, width))
        for x in _parts(_matrix(column, length)):
            z = got.whiten(x)
            total += np.vstack([z.T @ z, z.sum(axis=0)])
        return total

    moments = added(fit, part, width) / n
    covered = moments[:width] - np.outer(moments[width], moments[width])
    got.identity_error = float(np.abs(covered - np.eye(width)).max())
    return got


def whitened(embeddings: DataFrame, components: int = 4) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable vector of
    ``embeddings`` (vec_id, embedding) and component, and the largest residual of the axes (residual) beside them."""
    schema = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, "
              "residual double")
    rows = embeddings.select(F.col("vec_id").cast("bigint"), "embedding")
    fit = fit_axes(rows.select("embedding"), components)
    if fit is None or not len(fit.values):
        return embeddings.sparkSession.createDataFrame([], schema)
    width = len(fit.values)

    def make():
        def f(batch: pa.RecordBatch) -> dict:
            places, vectors = quantised(batch.column(1), fit.length)
            x = np.array(vectors, np.int64).reshape(len(vectors), fit.length)
            m = len(x)
            return {
                "vec_id": pc.take(batch.column(0), pa.array(np.repeat(places, width))),
                "component": np.tile(np.arange(1, width + 1, dtype=np.int32), m),
                "n": np.full(m * width, fit.n),
                "deviation": [d for d in fit.deviations(x) for _ in range(width)],
                "whitened": fit.whiten(x).reshape(-1),
                "explained": np.tile(fit.values / fit.trace, m),
                "identity_error": np.full(m * width, fit.identity_error),
                "residual": np.full(m * width, fit.residuals.max()),
            }
        return f

    return map_columns(rows, schema, make)
