"""Embedding whitening: distributed centred covariance, its leading eigenvectors, broadcast projection.

Every entry c becomes the whole number floor(1024 * c) + 100000, so that counts and sums are exact. A first pass adds
the vectors up, a second one the products of the centred vectors, task by task; what the tasks found is added in a fixed
order. The covariance matrix, dimension by dimension in size however many vectors there are, is taken apart on the
driver: Householder reflections make it tridiagonal, bisection on Sturm counts finds the leading eigenvalues, inverse
iteration their eigenvectors, those of close eigenvalues made orthogonal to each other, and the reflections turn them
back. Mean and components go to all tasks, which project the vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.columns import quoted
from starmart.llm.common import prepare_workers, staged

SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 30)  # entries beyond it would not stay exact as whole numbers
EPSILON = float(np.finfo(float).eps)
FOLDS = 64  # groups of tasks whose matrices are added first


def whole_numbers(column: pa.Array, size: int) -> np.ndarray:
    """The vectors of a list column, all of ``size`` entries, as rows of whole numbers."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return np.floor(SCALE * values.astype(np.float64)).astype(np.int64) + SHIFT


def sound_vectors(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, vector) of the rows whose vector has entries, all of them numbers of a size that stays exact."""
    numbers = quoted(vector).cast("array<double>")
    unsound = F.exists(numbers, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LARGEST))
    return vectors.select(quoted(id).alias("_llm_id"), numbers.alias("_llm_vector")).where(
        F.col("_llm_vector").isNotNull() & (F.size("_llm_vector") > 0) & ~unsound
    )


def vector_sums(sound: DataFrame) -> tuple[int, int, np.ndarray]:
    """(dimensions, vectors, sum per dimension) of the commonest length, the longer one of two."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            column = batch.column(0)
            lengths = np.diff(column.offsets.to_numpy())
            for size in np.unique(lengths).tolist():
                rows = whole_numbers(column.filter(pa.array(lengths == size)), size)
                n, sums = totals.get(size, (0, 0))
                totals[size] = (n + len(rows), sums + rows.sum(axis=0))
        for size, (n, sums) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, v)) for v in (size, n)] + [pa.array(np.arange(size)), pa.array(sums)],
                ["size", "n", "place", "total"],
            )

    parts = sound.select("_llm_vector").mapInArrow(add_up, "size long, n long, place long, total long")
    totals = parts.groupBy("size", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    totals = staged(totals, "vector-sums")
    commonest = totals.where("place = 0").orderBy(F.desc("n"), F.desc("size")).select("size", "n").first()
    if commonest is None:
        return 0, 0, np.zeros(0, np.int64)
    rows = totals.where(F.col("size") == commonest["size"]).orderBy("place").collect()
    return commonest["size"], commonest["n"], np.array([r.total for r in rows], np.int64)


def covariance(sound: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """Covariance of the whole-number vectors, divisor ``n``, centred before they are multiplied."""
    size, mean = len(sums), sums / n

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            centred = whole_numbers(batch.column(0), size) - mean
            total += centred.T @ centred
        task = np.full(size, TaskContext.get().partitionId())
        rows = pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * size), pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(task), rows], ["row", "task", "values"])

    def added(parts: DataFrame, order: str, *by: str) -> DataFrame:
        # Always in the same order: a repeated task must not change the last digits.
        ordered = F.array_sort(F.collect_list(F.struct(order, "values")))
        total = F.reduce(
            ordered, F.array_repeat(F.lit(0.0), size), lambda sum_, p: F.zip_with(sum_, p["values"], lambda a, b: a + b)
        )
        return parts.groupBy(*by).agg(total.alias("values"))

    parts = sound.select("_llm_vector").mapInArrow(multiply, "row long, task long, values array<double>")
    folded = added(parts.withColumn("fold", F.col("task") % FOLDS), "task", "row", "fold")
    rows = added(folded, "fold", "row").orderBy("row").collect()
    matrix = np.array([r["values"] for r in rows]) / n
    return (matrix + matrix.T) / 2


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, side diagonal, and the unit vectors of the Householder reflections that led to them."""
    a = matrix.astype(np.float64).copy()
    size = len(a)
    reflections = []
    for k in range(size - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        v[0] += length if v[0] >= 0 else -length
        norm = np.linalg.norm(v)
        if norm == 0:
            reflections.append(np.zeros(size - k - 1))
            continue
        v /= norm
        reflections.append(v)
        part = a[k + 1 :, k + 1 :]
        p = part @ v
        w = p - (v @ p) * v
        part -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
    return np.diag(a).copy(), np.array([a[k + 1, k] for k in range(size - 1)]), reflections


def sturm_counts(diagonal: np.ndarray, side: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are less than each value of ``at``."""
    least = EPSILON * max(np.abs(diagonal).max(), np.abs(side).max(initial=0.0), np.finfo(float).tiny / EPSILON)
    counts = np.zeros(len(at), int)
    q = np.ones(len(at))
    for d, e in zip(diagonal, [0.0, *side], strict=True):
        q = d - at - e * e / q
        q = np.where(np.abs(q) < least, -least, q)
        counts += q < 0
    return counts


def leading_eigenvalues(diagonal: np.ndarray, side: np.ndarray, number: int) -> np.ndarray:
    """The ``number`` greatest eigenvalues, falling, by bisection until the bounds meet."""
    size = len(diagonal)
    radius = np.zeros(size)
    radius[:-1] += np.abs(side)
    radius[1:] += np.abs(side)
    low = np.full(number, (diagonal - radius).min())
    high = np.full(number, (diagonal + radius).max())
    margin = EPSILON * max(1.0, np.abs(low[0]), np.abs(high[0])) * size
    low, high = low - margin, high + margin
    wanted = size - 1 - np.arange(number)  # so many eigenvalues are smaller
    while True:
        middle = (low + high) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return middle
        below = sturm_counts(diagonal, side, middle) <= wanted
        low, high = np.where(open_ & below, middle, low), np.where(open_ & ~below, middle, high)


def solve_shifted(diagonal: np.ndarray, side: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """x with (T - shift) x = right, by elimination with row exchanges; pivots are at least ``least``."""
    size = len(diagonal)
    d, upper, second = diagonal - shift, np.append(side, 0.0), np.zeros(size)
    x = right.copy()
    for k in range(size - 1):
        below = side[k]
        if abs(below) > abs(d[k]):
            factor = d[k] / below
            d[k], upper[k], d[k + 1], second[k], upper[k + 1] = (
                below, d[k + 1], upper[k] - factor * d[k + 1], upper[k + 1], -factor * upper[k + 1],
            )
            x[k], x[k + 1] = x[k + 1], x[k] - factor * x[k + 1]
        else:
            if abs(d[k]) < least:
                d[k] = least
            factor = below / d[k]
            d[k + 1] -= factor * upper[k]
            x[k + 1] -= factor * x[k]
    if abs(d[-1]) < least:
        d[-1] = least
    x[-1] /= d[-1]
    for k in range(size - 2, -1, -1):
        x[k] -= upper[k] * x[k + 1]
        if k + 2 < size:
            x[k] -= second[k] * x[k + 2]
        x[k] /= d[k]
        if abs(x[k]) > 1e200:  # a nearly singular system; only the direction counts
            x /= abs(x[k])
    return x


def leading_eigenvectors(matrix: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of a symmetric matrix, greatest first, those above rounding only."""
    size = len(matrix)
    diagonal, side, reflections = tridiagonal(matrix)
    values = leading_eigenvalues(diagonal, side, min(number, size))
    norm = max(np.abs(diagonal).max() + 2 * np.abs(side).max(initial=0.0), np.finfo(float).tiny)
    values = values[values > size * EPSILON * norm]
    rng = np.random.default_rng(13)
    found: list[np.ndarray] = []
    shifts: list[float] = []
    for value in values:
        # Equal eigenvalues get shifts of their own; vectors of close ones are made orthogonal.
        shift = min(value, shifts[-1] - 4 * EPSILON * norm) if shifts else value
        shifts.append(shift)
        close = [v for v, s in zip(found, shifts, strict=False) if s - shift < 1e-3 * norm]
        x = rng.standard_normal(size)
        for _ in range(6):
            for v in close * 2:
                x -= (v @ x) * v
            x /= np.linalg.norm(x)
            x = solve_shifted(diagonal, side, shift, x, EPSILON * norm)
            x /= np.linalg.norm(x)
        for v in close * 2:
            x -= (v @ x) * v
        found.append(x / np.linalg.norm(x))
    vectors = np.array(found).reshape(len(found), size)
    for k in range(size - 3, -1, -1):
        v = reflections[k]
        part = vectors[:, k + 1 :]
        part -= 2 * np.outer(part @ v, v)
    return values, vectors


def squared_deviation(rows: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum of (n * x - S)^2 over the dimensions of each row, exact."""
    if n * (int(np.abs(rows).max(initial=0)) + 1) < 1 << 61:
        off = n * rows - sums
        if int(np.abs(off).max(initial=0)) ** 2 * rows.shape[1] < 1 << 63:
            return pa.array((off * off).sum(axis=1)).cast(pa.decimal128(19, 0)).cast(pa.decimal128(38, 0))
    total = [[n * x - s for x, s in zip(row, sums.tolist(), strict=True)] for row in rows.tolist()]
    from decimal import Decimal

    return pa.array([Decimal(sum(v * v for v in row)) for row in total], pa.decimal128(38, 0))


RESULT = "vector_id {}, n long, deviation decimal(38,0), whitened array<double>"


def whiten(vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """A row per sound vector and component: the vector's id, ``component`` (from 1), ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``.

    ``n`` is the number of sound vectors; ``deviation`` (decimal) the exact sum of (n * x - S)^2 over the dimensions;
    ``whitened`` the centred vector along the component, over the root of its eigenvalue; ``explained`` the
    eigenvalue's share of the variance; ``identity_error`` the largest absolute entry of the whitened covariance minus
    the identity, one value for all rows.

    * A vector that is null or empty, or holds a null, a NaN, an infinity or an entry beyond 2^30, is left out.
    * All vectors of the commonest length take part (the longer one of two); others are left out.
    * Rows that come again are vectors of their own; a null id stays null. Other columns do not matter, whatever their names.
    * Components without variance (an eigenvalue of zero, up to rounding) cannot be whitened and have no rows: fewer
      dimensions than components give fewer, equal vectors and an empty table none.
    """
    spark = vectors.sparkSession
    prepare_workers(spark)
    sound = sound_vectors(vectors, id, vector)
    id_type = sound.schema["_llm_id"].dataType.simpleString()
    size, n, sums = vector_sums(sound)
    if size:
        sound = sound.where(F.size("_llm_vector") == size)
        matrix = covariance(sound, n, sums)
        values, axes = leading_eigenvectors(matrix, components)
        trace = float(np.trace(matrix))
    else:
        values, axes, trace = np.zeros(0), np.zeros((0, 0)), 0.0
    k = len(values)
    shared = spark.sparkContext.broadcast((sums, (axes / np.sqrt(values)[:, None]).T if k else axes))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, scaled = shared.value
        for batch in batches:
            rows = whole_numbers(batch.column(1), size)
            along = (rows - sums / n) @ scaled
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(np.full(len(rows), n)), squared_deviation(rows, n, sums),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * k), pa.array(along.ravel())),
                ],
                ["vector_id", "n", "deviation", "whitened"],
            )

    projected = (sound if k else sound.where("false")).mapInArrow(project, RESULT.format(id_type))
    projected = staged(projected, "projected")
    error = identity_error(projected, k)
    shares = (values / trace).tolist() if k else []
    explained = F.array(*(F.lit(s) for s in shares)) if k else F.array().cast("array<double>")
    return projected.select(
        F.col("vector_id").alias(id), "n", "deviation", F.posexplode("whitened").alias("_llm_place", "whitened")
    ).select(
        quoted(id), (F.col("_llm_place") + 1).alias("component"), "n", "deviation", "whitened",
        F.get(explained, "_llm_place").alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )


def identity_error(projected: DataFrame, components: int) -> float | None:
    """The largest absolute entry of the covariance of ``whitened`` minus the identity; null without components."""
    entries = [
        F.abs(F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))) - F.lit(float(i == j)))
        for i in range(components)
        for j in range(i, components)
    ]
    return projected.agg(F.greatest(*entries, F.lit(0.0))).first()[0] if entries else None
