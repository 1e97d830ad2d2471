"""Helpers shared by the modules of this subpackage."""

from __future__ import annotations

import ctypes
import os
import re
import shutil
import sys
import tempfile
from typing import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Arrow batches are worked on in blocks of about this many characters.
BLOCK_CHARS = 1_000_000
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) under names that extra columns cannot clash with."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more
    )


def ship_package(spark: SparkSession) -> None:
    """Prepare a session for Python workers that import this package.

    Those of a job that was not started with it on its path get a copy from the driver. Arrow batches of texts are kept
    to ``BATCH_BYTES``: an executor holds two copies of a batch for every task.
    """
    import quaymaster

    if BATCH_BYTES < _bytes(spark.conf.get(BATCH_SETTING, "64m")):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))

    root = os.path.dirname(os.path.dirname(os.path.abspath(quaymaster.__file__)))
    on_path = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    sc = spark.sparkContext
    if any(p and os.path.realpath(p) == root for p in on_path) or getattr(sc, "_quaymaster_shipped", False):
        return
    sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), "quaymaster"), "zip", root, "quaymaster"))
    sc._quaymaster_shipped = True


def _bytes(text: str) -> int:
    """A size as Spark writes it, such as 64m or 67108864b."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", text.strip().lower()).groups()
    value = int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]
    return value if value > 0 else sys.maxsize


def tidy() -> None:
    """Return freed memory to the system: an idle worker would keep what its largest batch needed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


_HELD: dict = {}


def held(key, make: Callable):
    """The one object that a Python worker keeps from task to task; another key replaces it, as workers outlive a stage."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Give up what the worker has kept for an earlier stage."""
    _HELD.clear()


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], Iterable[dict]], schema: str, keeps: bool = False) -> DataFrame:
    """``mapInArrow`` over a function that yields column dictionaries for one input batch; ``keeps`` if it uses ``held``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ship_package(df.sparkSession)
    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            release()
        for batch in batches:
            for columns in work(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) for f in target], schema=target
                )
        tidy()

    return df.mapInArrow(run, schema)


def blocks_of(lengths: Iterable[int], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges whose lengths add up to about ``limit``; a longer row is a block of its own."""
    start, total, stop = 0, 0, 0
    for stop, n in enumerate(lengths, 1):
        if total and total + n > limit:
            yield start, stop - 1
            start, total = stop - 1, 0
        total += n
    if stop > start:
        yield start, stop


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def window_minima(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int, bits: int = 24) -> np.ndarray:
    """Sorted positions that are least in some window of ``width`` values inside one range [start, end).

    Values are compared without their lowest ``bits``, then the leftmost is taken; there may be 2**bits values.
    The choice in a window depends on the values in it only.
    """
    if len(values) < width:
        return np.zeros(0, np.int64)
    mask = np.uint64((1 << bits) - 1)
    low = (values & ~mask) | np.arange(len(values), dtype=np.uint64)
    size = 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
    inside = np.zeros(len(values) + 2, np.int32)
    long = ends - starts >= width
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - width + 1, -1)
    chosen = np.zeros(len(values), bool)
    chosen[(low[np.cumsum(inside)[: len(low)] > 0] & mask).astype(np.int64)] = True
    return np.flatnonzero(chosen)


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)
