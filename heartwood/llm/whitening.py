"""Whitening of embeddings onto their leading principal components, by spectrum slicing.

Vectors are put on a grid of integers, so that equal ones are found and sums are exact. The
covariance comes from two passes over the distinct vectors, sums first and then products of
centred entries, each added up per task and merged per row of the matrix; only these d and d x d
numbers reach the driver.

There the leading eigenvalues are isolated by inertia: the LDL^T factorisation of the covariance
less a shift has as many positive pivots as there are eigenvalues above the shift. Bisection on
those counts gives each wanted eigenvalue an interval of its own; Rayleigh quotient iteration then
converges cubically; two more counts, just below and just above the value found, certify its
number. Eigenvalues too close to be told apart share an interval and an orthonormal basis.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heartwood.llm.common import store

#: steps of the integer grid in one unit, and where its zero lies
STEPS, ZERO = 64, 1_000_000
#: entries beyond this are not on the grid exactly
WIDEST = 2.0**46
#: rows that are multiplied at once
ROWS = 4096


def on_grid(vector: Column) -> Column:
    """floor(64 c) + 1000000 of each entry; NULL for a vector that has to be left out.

    These are vectors that are NULL or hold an entry that is NULL, not finite, or beyond 2^46.
    """
    wide = vector.cast("array<double>")
    sound = F.forall(wide, lambda c: F.coalesce(F.abs(c) <= WIDEST, F.lit(False)))
    grid = F.transform(wide, lambda c: F.floor(c * STEPS).cast("long") + F.lit(ZERO))
    return F.when(sound, grid)


# --- eigenvalues and eigenvectors ---------------------------------------------


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """Numbers of positive, zero and negative eigenvalues of a symmetric matrix.

    Counted on the pivots of its LDL^T factorisation, from the last row up: the diagonal entry of
    the row, or of the row with which it has its largest entry, where that is large enough
    against the entries off the diagonal, else a block of both rows; so no multiplier grows.
    """
    a = np.array(matrix, float)
    signs = [0, 0, 0]  # negative, zero, positive
    enough = (1 + 17**0.5) / 8

    def swap(i: int, j: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    m = len(a)
    while m:
        k = m - 1
        off = np.abs(a[:k, k])
        r = int(off.argmax()) if k else 0
        largest = off[r] if k else 0.0
        single = abs(a[k, k]) >= enough * largest
        if not single:
            row = np.abs(a[r, :m])
            row[r] = 0
            if abs(a[k, k]) * row.max() >= enough * largest**2:
                single = True
            elif abs(a[r, r]) >= enough * row.max():
                swap(r, k)
                single = True
        if single:
            signs[1 + int(np.sign(a[k, k]))] += 1
            if a[k, k]:
                c = a[:k, k]
                a[:k, :k] -= np.outer(c, c / a[k, k])
            m -= 1
        else:  # such a block has one eigenvalue of each sign
            swap(r, k - 1)
            signs[0] += 1
            signs[2] += 1
            c = a[: k - 1, k - 1 : m]
            a[: k - 1, : k - 1] -= c @ np.linalg.solve(a[k - 1 : m, k - 1 : m], c.T)
            m -= 2
    return signs[2], signs[1], signs[0]


class Spectrum:
    """Leading eigenpairs of a covariance matrix, numbered by certified counts."""

    def __init__(self, covariance: np.ndarray):
        self.v = (covariance + covariance.T) / 2
        self.trace = float(np.trace(self.v))
        # every eigenvalue lies below the largest row sum
        self.top = float(np.abs(self.v).sum(1).max()) if len(self.v) else 0.0
        #: closer than this are eigenvalues that rounding does not tell apart
        self.noise = max(len(self.v), 16) * np.finfo(float).eps * self.top * 4
        self.counts: dict[float, int] = {}

    def above(self, shift: float) -> int:
        """How many eigenvalues are larger than ``shift``."""
        if shift not in self.counts:
            self.counts[shift] = inertia(self.v - shift * np.eye(len(self.v)))[0]
        return self.counts[shift]

    def slices(self, wanted: int) -> list[tuple[float, float, int, int]]:
        """Intervals (low, high, eigenvalues above high, inside) for the leading eigenvalues.

        Falling, disjoint, and each with one eigenvalue or with some that are no further apart
        than ``noise``; those not larger than ``noise`` are left out as zero.
        """
        out, open_ = [], [(self.noise, self.top * (1 + 1e-9) + self.noise)]
        while open_:
            low, high = open_.pop()
            upper, inside = self.above(high), self.above(low) - self.above(high)
            if not inside or upper >= wanted:
                continue
            if inside == 1 or high - low <= self.noise:
                out.append((low, high, upper, inside))
                continue
            middle = (low + high) / 2
            open_ += [(low, middle), (middle, high)]  # the higher half comes off first
        return out

    def _converge(self, low: float, high: float, known: list[np.ndarray]) -> tuple[float, np.ndarray]:
        """An eigenpair in (low, high] orthogonal to ``known`` by Rayleigh quotient iteration."""
        basis = np.array(known).reshape(-1, len(self.v))
        eye = np.eye(len(self.v))

        def unit(x: np.ndarray) -> np.ndarray:
            for _ in range(2):
                x = x - basis.T @ (basis @ x)
            return x / np.linalg.norm(x)

        dice = np.random.default_rng(len(known))
        while True:
            x = unit(dice.standard_normal(len(self.v)))
            value = (low + high) / 2
            smallest = np.inf
            for _ in range(100):
                try:
                    y = np.linalg.solve(self.v - value * eye, x)
                except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
                    y = np.linalg.solve(self.v - (value + self.noise / 16) * eye, x)
                x = unit(y / np.linalg.norm(y))
                quotient = float(x @ self.v @ x)
                residual = float(np.linalg.norm(self.v @ x - quotient * x))
                if low - self.noise <= quotient <= high + self.noise:
                    if residual >= smallest / 2 and residual <= self.noise:
                        return quotient, x
                    smallest = min(smallest, residual)
                    # inside the interval, and closer to it than to its ends: nothing else is near
                    if residual < min(quotient - low, high - quotient) or high - low <= self.noise:
                        value = quotient
                        continue
                # still drawn to a neighbour: narrow the slice by another count and go on from it
                low, high = self._halve(low, high)
                value = (low + high) / 2

    def _halve(self, low: float, high: float) -> tuple[float, float]:
        if high - low <= self.noise:
            return low, high
        middle = (low + high) / 2
        return (middle, high) if self.above(middle) > self.above(high) else (low, middle)

    def leading(self, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Eigenvalues, falling, and eigenvectors as rows: the first ``wanted`` larger than zero.

        Raises where the counts next to a value do not give it the number under which it is
        returned.
        """
        values: list[float] = []
        vectors: list[np.ndarray] = []
        for low, high, upper, inside in self.slices(wanted):
            found = []
            for _ in range(inside):
                value, vector = self._converge(low, high, vectors)
                found.append(value)
                vectors.append(vector)
            values += found
            margin = 2 * self.noise + (high - low if inside > 1 else 0)
            if self.above(max(found) + margin) > upper or self.above(min(found) - margin) < upper + inside:
                raise ArithmeticError(f"eigenvalues {upper + 1} to {upper + inside} are not certain")
        order = np.argsort(-np.array(values), kind="stable")[:wanted]
        return np.array(values)[order], np.array(vectors).reshape(-1, len(self.v))[order]


# --- passes over the vectors --------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column without NULLs, all of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: the number of vectors and the sum of each dimension, once per task."""
    n, total = 0, None
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column("x"))
            n += len(x)
            # in Python integers, whatever the range of the data
            total = (total if total is not None else 0) + x.sum(0, dtype=object)
    if n:
        yield pa.record_batch(
            {
                "dimension": pa.array(range(len(total)), pa.int32()),
                "n": pa.array([n] * len(total), pa.int64()),
                "total": pa.array([str(t) for t in total], pa.string()),
            }
        )


def _products(mean: np.ndarray, scale: np.ndarray):
    """Arrow function: X^T X of the centred vectors times ``scale``, once per task, by rows."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                x = (_matrix(batch.column("x").slice(at, ROWS)) - mean) @ scale
                # the last column sums the vectors themselves
                part = np.concatenate([x.T @ x, x.sum(0)[:, None]], 1)
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch(
                {
                    "row": pa.array(range(len(total)), pa.int32()),
                    "products": pa.array(list(total), pa.list_(pa.float64())),
                }
            )

    return multiply


def _scatter(vectors: DataFrame, n: int, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Covariance of the vectors less ``mean`` and times ``scale``, divisor n."""
    parts = vectors.mapInArrow(_products(mean, scale), "row int, products array<double>")
    rows = (
        parts.select("row", F.posexplode("products").alias("column", "p"))
        .groupBy("row", "column")
        .agg(F.sum("p").alias("p"))
        .collect()  # d x (d + 1) numbers
    )
    out = np.zeros((scale.shape[1], scale.shape[1] + 1))
    for r in rows:
        out[r["row"], r["column"]] = r.p
    centre = out[:, -1] / n
    return out[:, :-1] / n - np.outer(centre, centre)


def _project(n: int, sums: list[int], scale: np.ndarray, explained: np.ndarray, error: float):
    """Arrow function: the whitened components of each vector, a row for each."""
    mean = np.array([s / n for s in sums])
    totals = np.array(sums, object)
    k = scale.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = _matrix(part.column("x"))
                whitened = (x - mean) @ scale
                deviation = [
                    d if d < 2**63 else None for d in _squares(n, x, totals)
                ]
                many = np.repeat(np.arange(len(x)), k)
                yield pa.record_batch(
                    {
                        "vec_id": part.column("vec_id").take(pa.array(many)),
                        "component": pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                        "n": pa.array(np.full(len(many), n), pa.int64()),
                        "deviation": pa.array(deviation, pa.int64()).take(pa.array(many)),
                        "whitened": pa.array(whitened.ravel(), pa.float64()),
                        "explained": pa.array(np.tile(explained, len(x)), pa.float64()),
                        "identity_error": pa.array(np.full(len(many), error), pa.float64()),
                    }
                )

    return project


def _squares(n: int, x: np.ndarray, totals: np.ndarray) -> list[int]:
    """Sum over the dimensions of (n x - S)^2, exactly.

    In 64-bit integers where an upper bound shows that they hold it, else in Python's.
    """
    widest = n * int(np.abs(x).max()) + max(abs(t) for t in totals)
    if widest < 2**62:
        y = n * x - totals.astype(np.int64)
        if x.shape[1] * int(np.abs(y).max()) ** 2 < 2**63:
            return (y * y).sum(1).tolist()
    y = n * x.astype(object) - totals
    return (y * y).sum(1).tolist()


RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def whiten(vectors: DataFrame, components: int = 16) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error).

    ``vectors`` has vec_id and embedding. Fitted on the ``n`` distinct vectors, each once; every
    row is whitened, also with a repeated or missing vec_id. Vectors that are NULL or hold
    entries that are NULL, not finite or beyond 2^46 are left out. So are vectors of another
    length than most distinct ones have (of equally common lengths the longer); empty ones
    have no dimension and give nothing. There are as many components as eigenvalues larger than
    rounding, ``components`` at most: none for an empty table or where all vectors are equal.
    Equal eigenvalues share their space: any orthonormal basis of it is returned. ``deviation`` is
    NULL where it exceeds 64 bits. Other columns of ``vectors`` play no role.
    """
    spark = vectors.sparkSession
    grid = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), on_grid(F.col("embedding")).alias("x"))
    grid = grid.where(F.size("x") > 0)
    fit = store(grid.select("x").distinct())
    lengths = fit.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    if usual is None:
        return spark.createDataFrame([], RESULT)
    d, n = usual.d, usual.n
    fit, grid = fit.where(F.size("x") == d), grid.where(F.size("x") == d)

    totals = (
        fit.mapInArrow(_sums, "dimension int, n long, total string")
        .groupBy("dimension")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        .collect()  # one number per dimension
    )
    sums = [int(r.total) for r in sorted(totals, key=lambda r: r.dimension)]
    mean = np.array([s / n for s in sums])
    spectrum = Spectrum(_scatter(fit, n, mean, np.eye(d)))
    values, directions = spectrum.leading(components)
    if not len(values):
        return spark.createDataFrame([], RESULT)
    scale = directions.T / np.sqrt(values)
    error = float(np.abs(_scatter(fit, n, mean, scale) - np.eye(len(values))).max())
    explained = values / spectrum.trace
    return grid.mapInArrow(_project(n, sums, scale, explained, error), RESULT)
