"""Vectors that take part in the operators over embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F


def finite_vectors(vectors: DataFrame, id_column: str, vector: str, *more: str) -> DataFrame:
    """``id``, ``vec`` as doubles, and ``more`` of the rows whose vector is not null and holds no null or non-finite component."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), v.alias("vec"), *more)
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vec").isNotNull() & ~bad)


def scaled_integers(c: np.ndarray, scale: int, offset: int, limit: int) -> np.ndarray:
    """floor(scale * c) + offset as int64; components beyond ``limit`` have no exact place in a long and are an error."""
    x = np.floor(c * scale)
    if x.size and np.abs(x).max() >= limit:
        raise ValueError(f"component beyond {limit // scale}: its integer is too large for exact sums")
    return x.astype(np.int64) + offset


def as_lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of a matrix as a list column."""
    offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(x).reshape(-1), kind))


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this run has written to the shared folder and reads no more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
