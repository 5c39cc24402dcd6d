"""Whitening of embeddings by their leading principal components.

Spark sums the integer vectors exactly, then sums the products of centred vectors: every task holds one
square matrix, and rows of these matrices are added up in tasks again.  The covariance, whose
size follows the dimensions and not the rows, is decomposed on the driver: Householder
reflections make it tridiagonal, Sturm counts bisect the leading eigenvalues, and inverse
iteration finds their vectors, kept orthogonal to the others of a cluster.  The components
are broadcast, rows are projected where they are scanned and written once; the covariance of
the projections, the check of the whole, is an aggregate over that table.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.operators.stored import written_once

GRID, SHIFT = 1024, 100_000
COMPONENTS = 8
MOST_WIDTH = 4096
# Integers up to here are exact as doubles; larger components are cut to it.
EXACT = 1 << 53
LONGEST = (1 << 63) - 1
STEPS = 5
CLOSE = 1e-3


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and reflectors (one a column) of a symmetric matrix."""
    a = np.array(matrix, float)
    width = len(a)
    reflectors = np.zeros((width, width))
    for k in range(width - 2):
        below = a[k + 1:, k]
        size = np.linalg.norm(below)
        if size == 0.0 or not below[1:].any():
            continue
        v = below.copy()
        v[0] += np.copysign(size, v[0])
        v /= np.linalg.norm(v)
        sign = -np.copysign(size, below[0])
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = 2.0 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1:, k] = 0.0
        a[k + 1, k] = sign
        reflectors[k + 1:, k] = v
    return a.diagonal().copy(), a.diagonal(-1).copy(), reflectors


def counts_below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each shift: negative pivots of the Sturm sequence."""
    squares = np.concatenate(([0.0], off * off))
    least = max(np.finfo(float).tiny, np.finfo(float).eps ** 2 * max(squares.max(), (diagonal ** 2).max(), 1e-290))
    pivot = np.ones_like(shifts)
    count = np.zeros(len(shifts), int)
    for d, e2 in zip(diagonal, squares):
        pivot = d - shifts - e2 / pivot
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues in falling order, bisected to the last bit."""
    reach = np.abs(np.concatenate((off, [0.0]))) + np.abs(np.concatenate(([0.0], off)))
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    span = np.maximum(np.abs(low), np.abs(high)) * np.finfo(float).eps * 4
    low, high = low - span, high + span
    rank = len(diagonal) - 1 - np.arange(k)
    while True:
        middle = low + (high - low) / 2
        done = (middle <= low) | (middle >= high)
        if done.all():
            return middle
        below = counts_below(diagonal, off, middle) <= rank
        low, high = np.where(below & ~done, middle, low), np.where(~below & ~done, middle, high)


class _Shifted:
    """Elimination of a tridiagonal matrix less a shift, rows exchanged for the larger pivot."""

    def __init__(self, diagonal: np.ndarray, off: np.ndarray, shift: float, floor: float):
        n = len(diagonal)
        self.main, self.upper = (diagonal - shift).tolist(), [*off.tolist(), 0.0]
        self.second, self.factor, self.swapped = [0.0] * n, [0.0] * n, [False] * n
        for i in range(n - 1):
            lower = float(off[i])
            if abs(lower) > abs(self.main[i]):
                self.swapped[i] = True
                row = (lower, self.main[i + 1], self.upper[i + 1])
                f = self.main[i] / lower
                self.main[i + 1], self.upper[i + 1] = self.upper[i] - f * row[1], -f * row[2]
                self.main[i], self.upper[i], self.second[i] = row
            else:
                f = lower / self.main[i] if self.main[i] else 0.0
                self.main[i + 1] -= f * self.upper[i]
            self.factor[i] = f
        self.main = [p if abs(p) > floor else (floor if p >= 0 else -floor) for p in self.main]

    def solve(self, right: np.ndarray) -> np.ndarray:
        y, n = right.tolist(), len(right)
        for i in range(n - 1):
            if self.swapped[i]:
                y[i], y[i + 1] = y[i + 1], y[i] - self.factor[i] * y[i + 1]
            else:
                y[i + 1] -= self.factor[i] * y[i]
        for i in range(n - 1, -1, -1):
            rest = y[i]
            if i + 1 < n:
                rest -= self.upper[i] * y[i + 1]
            if i + 2 < n:
                rest -= self.second[i] * y[i + 2]
            y[i] = rest / self.main[i]
        return np.array(y)


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of falling ``values``, one a column.

    Values nearer than a thousandth of the norm to the one before form a cluster; a vector is made
    orthogonal to the earlier ones of its cluster in every step.
    """
    norm = max(np.abs(diagonal).max(initial=0.0) + 2 * np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    draw = np.random.default_rng(13)
    out = np.zeros((len(diagonal), len(values)))
    first = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLOSE * norm:
            first = j
        shifted = _Shifted(diagonal, off, float(value), np.finfo(float).eps * norm)
        y = draw.uniform(-1.0, 1.0, len(diagonal))
        for _ in range(STEPS):
            y = shifted.solve(y / np.linalg.norm(y))
            y /= np.abs(y).max()
            for _ in range(2):
                y -= out[:, first:j] @ (out[:, first:j].T @ y)
        out[:, j] = y / np.linalg.norm(y)
    return out


def leading_components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``k`` positive eigenvalues in falling order and their unit vectors, one a column.

    Values that are nothing but rounding errors of the trace are left out.
    """
    trace = float(np.trace(covariance))
    if not len(covariance) or not trace > 0:
        return np.zeros(0), np.zeros((len(covariance), 0))
    diagonal, off, reflectors = tridiagonal(covariance / trace)
    values = leading_values(diagonal, off, min(k, len(covariance)))
    values = values[values > 4 * len(covariance) * np.finfo(float).eps]
    vectors = tridiagonal_vectors(diagonal, off, values)
    for column in range(len(covariance) - 3, -1, -1):
        v = reflectors[:, column]
        vectors -= 2.0 * np.outer(v, v @ vectors)
    return values * trace, vectors / np.linalg.norm(vectors, axis=0)


def gridded(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id, x (array of long): floor(1024 * c) + 100000 of vectors with finite entries only.

    Beyond 2^53 a component is cut, where the product would leave the range of long.
    """
    raw = F.col(vector_column).cast("array<double>")
    return vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), raw.alias("v")).where(
        F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    ).select("vec_id", F.transform("v", lambda c: F.floor(F.greatest(F.least(
        c * GRID, F.lit(float(EXACT))), F.lit(-float(EXACT)))) + F.lit(SHIFT).cast("bigint")).alias("x"))


def _integers(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows as longs; components that a shorter vector lacks are the grid's zero."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(int)
    out = np.full((len(lengths), width), SHIFT, np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def exact_sums(rows: DataFrame, width: int) -> list[int]:
    """Sum of every dimension, exact: whole numbers of up to 38 digits add up in Spark."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * width
        for batch in batches:
            x = _integers(batch.column(0), width)
            # Halves of 32 bits cannot run over within a batch.
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            totals = [t + (h << 32) + n for t, h, n in zip(totals, high, low)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array([Decimal(t) for t in totals], pa.decimal128(38, 0))],
            ["d", "total"])

    summed = rows.select("x").mapInArrow(partial, "d int, total decimal(38,0)").groupBy("d").agg(
        F.sum("total").alias("total"))
    found = {r["d"]: int(r["total"]) for r in summed.collect()}
    return [found[d] for d in range(width)]


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the value lists of every run of equal keys (i, values)."""
    current, total = None, None
    for batch in batches:
        for i, values in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = values.values.to_numpy(zero_copy_only=False)
            if i == current:
                total = total + part
                continue
            if current is not None:
                yield pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([total])], ["i", "values"])
            current, total = i, part.copy()
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([total])], ["i", "values"])


def covariance(rows: DataFrame, mean: np.ndarray, n: int) -> np.ndarray:
    """Covariance of the x-vectors: centred before multiplying, divisor ``n``.

    A task adds up one matrix and gives its upper triangle row by row; equal rows
    meet in one task, at most as many as there are dimensions.
    """
    width = len(mean)
    shared = rows.sparkSession.sparkContext.broadcast(mean)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            centred = _integers(batch.column(0), width) - shared.value
            total += centred.T @ centred
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array([total[i, i:] for i in range(width)], pa.list_(pa.float64()))],
            ["i", "values"])

    parts = rows.select("x").mapInArrow(partial, "i int, values array<double>")
    added = parts.repartition("i").sortWithinPartitions("i").mapInArrow(_added, "i int, values array<double>")
    out = np.zeros((width, width))
    for r in added.collect():
        out[r["i"], r["i"]:] = r["values"]
    return (out + np.triu(out, 1).T) / n


def projected(rows: DataFrame, sums: list[int], n: int, mean: np.ndarray, scaled: np.ndarray) -> DataFrame:
    """vec_id, deviation, w: rows projected on the broadcast columns of ``scaled``."""
    width = len(mean)
    shared = rows.sparkSession.sparkContext.broadcast((sums, mean, scaled))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, mean, scaled = shared.value
        whole = np.array(sums, object)
        for batch in batches:
            x = _integers(batch.column(1), width)
            reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
            if reach < 1 << 62 and (far := int(np.abs(n * x - whole.astype(np.int64)).max(initial=0))) ** 2 * width < 1 << 62:
                away = n * x - whole.astype(np.int64)
                deviation = (away * away).sum(axis=1)
            else:
                # Wider than long on the way: Python's integers, the result cut to the range of long.
                away = n * x.astype(object) - whole
                deviation = np.array([min(int(d), LONGEST) for d in (away * away).sum(axis=1)], np.int64)
            w = (x - mean) @ scaled
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviation, pa.int64()), pa.array(list(w), pa.list_(pa.float64()))],
                ["vec_id", "deviation", "w"])

    return rows.select("vec_id", "x").mapInArrow(project, "vec_id bigint, deviation bigint, w array<double>")


def identity_error(rows: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of ``w`` minus the identity; two aggregates."""
    means = rows.agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = rows.agg(*[F.avg((F.col("w")[i] - means[i]) * (F.col("w")[j] - means[j])).alias(f"c{i}_{j}")
                       for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened(vectors: DataFrame, k: int = COMPONENTS, id_column: str = "vec_id",
             vector_column: str = "embedding") -> DataFrame:
    """A row for every vector and component up to ``k``: vec_id, component, n, deviation, whitened, explained,
    identity_error.

    Vectors that are null or hold null or non-finite entries take no part.  Rows that repeat an id
    or have none are rows like any other.  Entries that a shorter vector lacks count as zero.
    Components whose eigenvalue is zero but for rounding do not exist, so fewer than ``k`` come
    back when the vectors span less, and none (no rows) when all are equal or there are no vectors.
    A deviation beyond the range of long is cut to it.  More than 4,096 dimensions are refused:
    the covariance is held by the driver.
    """
    spark = vectors.sparkSession
    nothing = spark.range(0).select(
        F.col("id").alias("vec_id"), F.lit(0).alias("component"), F.col("id").alias("n"), F.col("id").alias("deviation"),
        F.lit(0.0).alias("whitened"), F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error"))
    rows = written_once(gridded(vectors, id_column, vector_column))
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width")).first()
    n, width = shape["n"], shape["width"] or 0
    if width > MOST_WIDTH:
        raise ValueError(f"vectors of more than {MOST_WIDTH} dimensions")
    if not n or not width:
        return nothing
    sums = exact_sums(rows, width)
    mean = np.array([s / n for s in sums])
    matrix = covariance(rows, mean, n)
    values, components = leading_components(matrix, k)
    if not len(values):
        return nothing
    flat = written_once(projected(rows, sums, n, mean, components / np.sqrt(values)))
    error = identity_error(flat, len(values))
    explained = F.array(*[F.lit(float(e / np.trace(matrix))) for e in values])
    return flat.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        explained[F.col("at")].alias("explained"), F.lit(float(error)).alias("identity_error"))
