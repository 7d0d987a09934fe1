"""Embedding whitening from polarised covariances.

Each entry c of a vector becomes the whole number x = floor(256 * c). The fit list holds
each distinct x vector once; with n vectors and per-dimension sums S, the centred value of a
dimension is the whole number d = n * x - S. Tasks add up, in whole numbers and so exactly,
the squares of d for every dimension and of d_i + d_j for every pair of dimensions; no
product of two different dimensions is taken anywhere. Since

    sum((d_i + d_j)**2) = sum(d_i**2) + sum(d_j**2) + 2 * sum(d_i * d_j),

the differences of these sums give every covariance, without a rounding error before the
final division. The matrix (dimensions squared, whatever the number of vectors) is assembled
on the driver for ``numpy.linalg.eigh``; projecting and the check that the whitened values
have the identity as covariance run on the rows again.

Rows whose vector is null, or holds a null, NaN or infinite entry, are dropped, as are empty
vectors. Vectors must have one length: the one most rows have (the longer, if two are equally
frequent); rows of another length are dropped too. Repeated rows are returned as often as they
occur and fitted once. A null id is returned as it is. ``deviation`` is null where it exceeds a
long. Components without variance (an eigenvalue of at most ``FLAT`` of the trace) have a null
``whitened`` and no part in ``identity_error``, which is null if there is none. An empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import saved, workspace

SCALE = 256
COMPONENTS = 4
#: Share of the trace up to which an eigenvalue counts as zero.
FLAT = 1e-13
#: Rows whose squares are added up at a time.
ROWS = 1 << 12
#: Sums leave a task as high * PART + low, so that Spark adds them exactly however many tasks there are.
PART = 10**18
_LIMB = 24
_LIMB_MASK = (1 << _LIMB) - 1
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(vector: Column) -> Column:
    """Neither null nor empty, and all entries finite numbers."""
    inf = F.lit(float("inf"))
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < inf))
    return vector.isNotNull() & (F.size(vector) > 0) & good


def whole_numbers(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the usable vectors of the most frequent length."""
    own = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    good = own.where(usable(F.col("v")))
    length = good.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size = length[0]["size"] if length else 0
    return good.where(F.size("v") == size).select("id", F.transform("v", lambda c: F.floor(c * SCALE).cast("long")).alias("x"))


def matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def square_sums(d: np.ndarray) -> np.ndarray:
    """Exact column sums of d**2 as Python numbers; d: a few thousand rows of 64-bit numbers."""
    top = int(np.abs(d).max(initial=0))
    if top * top * len(d) < 1 << 63:
        return np.einsum("ij,ij->j", d, d).astype(object)
    if top < 1 << 48:  # d = a * 2**24 + b, so the squares of a and b and twice their product stay in 64 bits
        a, b = d >> _LIMB, d & _LIMB_MASK
        parts = (np.einsum("ij,ij->j", p, q).astype(object) for p, q in ((a, a), (a, b), (b, b)))
        high, middle, low = parts
        return high * (1 << 2 * _LIMB) + middle * (2 << _LIMB) + low
    return (d.astype(object) ** 2).sum(0)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S; of Python's numbers where 64 bits might not do."""
    top = n * int(max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))) + max(map(abs, sums), default=0)
    if top < 1 << 61:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _by_task(measure, size: int):
    """A mapper that adds up ``measure`` (a dict of whole numbers by (i, j)) over its rows."""

    def run(batches):
        total: dict[tuple[int, int], int] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                for key, value in measure(matrix(batch.slice(start, ROWS).column("x"), size)):
                    total[key] = total.get(key, 0) + int(value)
        keys = sorted(total)
        yield pa.RecordBatch.from_pydict(
            {
                "i": pa.array([k[0] for k in keys], pa.int32()),
                "j": pa.array([k[1] for k in keys], pa.int32()),
                "high": pa.array([str(total[k] // PART) for k in keys], pa.string()),
                "low": pa.array([total[k] % PART for k in keys], pa.int64()),
            }
        )

    return run


def exact_sums(fit: DataFrame, size: int, measure) -> dict[tuple[int, int], int]:
    """Sums of ``measure`` over all rows; as many rows reach the driver as there are keys."""
    parts = fit.select("x").mapInArrow(_by_task(measure, size), "i int, j int, high string, low long")
    wide = "decimal(38,0)"
    summed = parts.groupBy("i", "j").agg(F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low"))
    return {(r.i, r.j): int(r.high) * PART + int(r.low) for r in summed.collect()}


def dimension_sums(fit: DataFrame, size: int) -> list[int]:
    def measure(x):
        top = int(np.abs(x).max(initial=0))
        total = x.sum(0) if top * len(x) < 1 << 62 else x.astype(object).sum(0)
        return [((i, i), v) for i, v in enumerate(total)]

    found = exact_sums(fit, size, measure)
    return [found.get((i, i), 0) for i in range(size)]


def covariance(fit: DataFrame, size: int, n: int, sums: list[int]) -> np.ndarray:
    """The covariances of x over the fit list, divisor n, from sums of squares only."""

    def measure(x):
        d = centred(x, n, sums)
        for i in range(size):
            yield (i, i), square_sums(d[:, i : i + 1])[0]
            if i + 1 < size:
                yield from (((i, i + 1 + k), v) for k, v in enumerate(square_sums(d[:, i : i + 1] + d[:, i + 1 :])))

    squares = exact_sums(fit, size, measure)
    out, over = np.zeros((size, size)), n**3
    for i in range(size):
        out[i, i] = squares[i, i] / over
        for j in range(i + 1, size):
            out[i, j] = out[j, i] = (squares[i, j] - squares[i, i] - squares[j, j]) / (2 * over)
    return out


def project(x: np.ndarray, n: int, sums: list[int], axes: np.ndarray) -> np.ndarray:
    """Rows of whitened values; ``axes`` holds a column per component, divided by sqrt(e)."""
    return (centred(x, n, sums) / n).astype(float) @ axes


def identity_error(fit: DataFrame, n: int, sums: list[int], axes: np.ndarray) -> float | None:
    """Largest absolute entry of the whitened values' covariance over the fit list minus the identity."""
    size, k = axes.shape
    if not k:
        return None

    def totals(of):
        def run(batches):
            total = 0.0
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS):
                    total = total + of(project(matrix(batch.slice(start, ROWS).column("x"), size), n, sums, axes))
            if np.ndim(total):
                flat = np.ravel(total)
                yield pa.RecordBatch.from_pydict({"i": pa.array(range(len(flat)), pa.int32()), "v": pa.array(flat, pa.float64())})

        summed = fit.select("x").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
        return np.array([r.v for r in summed.orderBy("i").collect()])

    mean = totals(lambda z: z.sum(0)) / n
    spread = totals(lambda z: (z - mean).T @ (z - mean)).reshape(k, k) / n
    return float(np.abs(spread - np.eye(k)).max())


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: the whitened value, and figures of the fit (see the module)."""
    spark, path = rows.sparkSession, workspace(rows.sparkSession, "whitening")
    x = whole_numbers(rows, id_col, vector_col)
    fit = saved(x.select("x").distinct(), f"{path}/fit")
    first = fit.limit(1).collect()
    if not first:
        return spark.createDataFrame([], OUT)
    size, n = len(first[0]["x"]), fit.count()
    sums = dimension_sums(fit, size)
    cov = covariance(fit, size, n, sums)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1][: min(components, size)]
    values, vectors, trace = values[order], vectors[:, order], float(np.trace(cov))
    flat = values <= FLAT * trace
    axes = np.where(flat, 0.0, vectors / np.sqrt(np.where(flat, 1.0, values)))
    error = identity_error(fit, n, sums, axes[:, ~flat])
    explained = [float(v / trace) if trace > 0 else None for v in values]
    count = len(values)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                own = matrix(part.column("x"), size)
                d = centred(own, n, sums)
                top = int(np.abs(d).max(initial=0))
                square = np.einsum("ij,ij->i", d, d) if d.dtype != object and top * top * size < 1 << 63 else (d.astype(object) ** 2).sum(1)
                deviation = [int(v) if v < 1 << 63 else None for v in square]
                z = project(own, n, sums, axes)
                rows_ = part.num_rows
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": part.column("id").take(pa.array(np.repeat(np.arange(rows_), count))),
                        "component": pa.array(np.tile(np.arange(1, count + 1), rows_), pa.int32()),
                        "n": pa.array([n] * (rows_ * count), pa.int64()),
                        "deviation": pa.array([v for v in deviation for _ in range(count)], pa.int64()),
                        "whitened": pa.array([None if flat[k] else v for row in z.tolist() for k, v in enumerate(row)], pa.float64()),
                        "explained": pa.array(explained * rows_, pa.float64()),
                        "identity_error": pa.array([error] * (rows_ * count), pa.float64()),
                    }
                )

    return x.mapInArrow(run, OUT)
