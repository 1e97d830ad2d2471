"""Embedding whitening from exact, bit-sliced cross-products.

Every component c becomes the integer x = floor(1024 * c) + 100000. In blocks of rows each
dimension is shifted to start at zero, and its bit planes are packed across the rows into words of
64 bits. The cross-product of two dimensions is the sum over pairs of planes p, q of 2**(p + q)
times the bits that both planes have (an AND and a popcount); the shifts are put back exactly. A
task adds its blocks up and returns one number for each pair of dimensions; Spark adds the tasks
as decimals. With n rows, sums S and cross-products C, n * C - S S' is the centred scatter as
integers; divided by n * n it is the covariance whose eigenvectors are taken. A second pass over
the vectors projects them; a third one, over the few projected columns, measures their covariance.

What reaches the driver is one number for each pair of dimensions, and the pairs of components.

Rows whose vector is null or holds null or non-finite components are dropped; so are, where lengths
differ, vectors of another length than most (ties: the longer). Rows are taken as they are: repeated
rows and ids count and return again, a null id is kept, and other columns are not looked at. A
component without variance (up to rounding) has a null ``whitened`` and no part in the error. An
empty table gives no rows. A component beyond 2**30 is an error, as its square sums leave the decimals.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quaymaster.llm.common import ship_package
from quaymaster.llm.vectors import as_lists, finite_vectors, scaled_integers
from quaymaster.session import materialise

# Fixed values of the contract.
SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8

BLOCK_ROWS = 8192
LIMIT = 2**40
SAFE = 2**62
EXACT = pa.decimal128(38, 0)


# Bit-sliced sums -------------------------------------------------------------------------


def bit_planes(u: np.ndarray) -> np.ndarray:
    """(dims, bits, words): bit p of every row of a dimension, 64 rows to a word."""
    rows, dims = u.shape
    bits = max(1, int(u.max()).bit_length())
    planes = np.zeros((dims, bits, -(-rows // 64) * 8), np.uint8)
    for p in range(bits):
        packed = np.packbits(((u >> np.uint64(p)) & np.uint64(1)).astype(np.uint8).T, axis=1)
        planes[:, p, : packed.shape[1]] = packed
    return planes.view(np.uint64)


def block_sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums of the columns of ``x`` (int64) and their cross-products (upper triangle), as Python integers."""
    rows, dims = x.shape
    low = x.min(0)
    planes = bit_planes((x - low).astype(np.uint64))
    bits = planes.shape[1]
    # Weighted counts fit a long while 2 * bits and the bits of the row count do.
    kind = np.int64 if 2 * bits + rows.bit_length() < 62 else object
    weight = np.array([1 << p for p in range(2 * bits - 1)], dtype=kind)
    flat = planes.reshape(dims * bits, -1)
    sums = np.bitwise_count(planes).sum(2, dtype=np.int64).astype(kind) @ weight[:bits]
    cross = np.zeros((dims, dims), kind)
    for i in range(dims):
        for p in range(bits):
            both = np.bitwise_count(flat[i * bits :] & planes[i, p]).sum(1, dtype=np.int64)
            cross[i, i:] += both.reshape(-1, bits).astype(kind) @ weight[p : p + bits]
    sums, cross, low = sums.astype(object), cross.astype(object), low.astype(object)
    back = cross + np.multiply.outer(low, sums) + np.multiply.outer(sums, low) + rows * np.multiply.outer(low, low)
    return sums + rows * low, back


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for every length of the vectors of ``column`` but zero."""
    sizes = column.value_lengths().to_numpy()
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield rows, flat.reshape(len(rows), size)


def task_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dims, i, j, value) of a task: rows at (-1, -1), sums at (i, -1), cross-products at (i, j >= i)."""
    totals: dict[int, list] = {}
    for batch in batches:
        for _, c in by_length(batch.column("vec")):
            dims = c.shape[1]
            total = totals.setdefault(dims, [0, np.zeros(dims, object), np.zeros((dims, dims), object)])
            for start in range(0, len(c), BLOCK_ROWS):
                x = scaled_integers(c[start : start + BLOCK_ROWS], SCALE, OFFSET, LIMIT)
                sums, cross = block_sums(x)
                total[0] += len(x)
                total[1] += sums
                total[2] += cross
    for dims, (rows, sums, cross) in totals.items():
        i, j = np.triu_indices(dims)
        at_i = np.concatenate([[-1], np.arange(dims), i]).astype(np.int32)
        at_j = np.concatenate([np.full(dims + 1, -1), j]).astype(np.int32)
        values = [Decimal(int(v)) for v in [rows, *sums, *cross[i, j]]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at_i), dims, np.int32)), pa.array(at_i), pa.array(at_j), pa.array(values, EXACT)],
            names=["dims", "i", "j", "value"])


# Components ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """Everything that a row needs to be projected; bounded by the square of the dimensions."""

    rows: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling; zero where rounding leaves no variance
    vectors: np.ndarray  # (dims, components)
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else np.zeros(len(self.values))


def components_of(rows: int, sums: list[int], cross: dict[tuple[int, int], int], count: int) -> Whitening:
    """Leading eigenvectors of the covariance, from integers that are centred exactly."""
    dims = len(sums)
    cov = np.zeros((dims, dims))
    for (i, j), c in cross.items():
        cov[i, j] = cov[j, i] = (rows * c - sums[i] * sums[j]) / (rows * rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    least = max(float(values[0]), 0.0) * dims * np.finfo(np.float64).eps
    values = np.where(values > least, values, 0.0)
    top = np.abs(vectors).argmax(0)
    vectors = vectors * np.where(vectors[top, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    trace = sum(rows * cross[i, i] - sums[i] * sums[i] for i in range(dims)) / (rows * rows)
    return Whitening(rows, sums, values, vectors, trace)


def fit(vectors: DataFrame, count: int = COMPONENTS) -> Whitening | None:
    """Whitening of the (id, vec) rows of the commonest length; none if there are no rows."""
    partial = vectors.select("vec").mapInArrow(task_sums, "dims int, i int, j int, value decimal(38,0)")
    totals = materialise(partial.groupBy("dims", "i", "j").agg(F.sum("value").alias("value")), "cross-products")
    most = totals.where("i = -1").orderBy(F.desc("value"), F.desc("dims")).first()
    if most is None:
        return None
    at = {(r["i"], r["j"]): int(r["value"]) for r in totals.where(F.col("dims") == most["dims"]).collect()}
    sums = [at[i, -1] for i in range(most["dims"])]
    return components_of(at[-1, -1], sums, {k: v for k, v in at.items() if k[1] >= 0}, count)


def project(x: np.ndarray, w: Whitening) -> tuple[list[int], np.ndarray]:
    """Exact sum of (n * x - S)**2 for every row, and the whitened components (not a number without variance)."""
    n = w.rows
    near = [(2 * s + n) // (2 * n) for s in w.sums]  # S / n rounded, so that what is left is small
    rest = [s - n * r for s, r in zip(w.sums, near)]
    y = x - np.array(near, np.int64)
    largest, dims = int(np.abs(y).max(initial=0)), x.shape[1]
    fits = largest * max(largest, n) * dims < SAFE
    exact = y if fits else y.astype(object)
    squares = (exact * exact).sum(1).astype(object)
    crossed = (exact * np.array(rest, np.int64 if fits else object)).sum(1).astype(object)
    deviation = n * n * squares - 2 * n * crossed + sum(r * r for r in rest)
    centred = y - np.array([r / n for r in rest])
    some = w.values > 0
    spread = np.sqrt(np.where(some, w.values, 1.0))
    return list(deviation), np.where(some, centred @ w.vectors / spread, np.nan)


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation decimal(38,0), whitened, explained, identity_error) for every row and leading component."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = finite_vectors(vectors, id_column, vector)
    w = fit(rows, count)
    if w is None:
        return spark.createDataFrame([], "id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, c in by_length(batch.column("vec")):
                if c.shape[1] == len(w.sums):
                    deviation, white = project(scaled_integers(c, SCALE, OFFSET, LIMIT), w)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(place)), pa.array([Decimal(d) for d in deviation], EXACT), as_lists(white, pa.float64())],
                        names=["id", "deviation", "white"])

    done = materialise(rows.mapInArrow(run, "id bigint, deviation decimal(38,0), white array<double>"), "whitened")
    some = [k for k in range(len(w.values)) if w.values[k] > 0]
    pairs = [(a, b) for a in some for b in some if a <= b]
    error = 0.0
    if pairs:
        at = lambda k: F.get("white", F.lit(k))
        measured = done.agg(*[F.covar_pop(at(a), at(b)).alias(f"c{a}_{b}") for a, b in pairs]).first()
        error = max(abs(measured[f"c{a}_{b}"] - (a == b)) for a, b in pairs)
    shares = F.array(*[F.lit(float(e)) for e in w.explained])
    return done.select("id", "deviation", F.posexplode("white").alias("at", "white")).select(
        "id", (F.col("at") + 1).alias("component"), F.lit(w.rows).cast("bigint").alias("n"), "deviation",
        F.when(~F.isnan("white"), F.col("white")).alias("whitened"), F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"))
