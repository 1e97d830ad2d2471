"""Id sketches of an archive, kept beside its partitions where readers of the data do not look."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from quaymaster.operators.membership import Sketches, count_parts, fill_blocks
from quaymaster.session import materialise

PARTS = "event_date date, event_hour int, ids bigint, low string, high string, blocks bigint, run string"
BLOCKS = "event_date date, event_hour int, run string, block bigint, words array<bigint>"


def sketch_path(archive_path: str) -> str:
    """Spark takes no folder that begins with an underscore for data."""
    return f"{archive_path}/_ids"


def write_sketches(rows: DataFrame, event_id: str, archive_path: str) -> DataFrame:
    """Sketch rows that are about to be appended; returns their counts by partition.

    Sketches are written before the rows: one that names rows which never came costs a lookup, rows
    without a sketch would be taken for new. Filters come before the parts that lead to them.
    """
    path = sketch_path(archive_path)
    parts = materialise(count_parts(rows, event_id, uuid.uuid4().hex), "sketch-parts")
    fill_blocks(rows, event_id, parts).write.mode("append").parquet(f"{path}/blocks")
    parts.write.mode("append").parquet(f"{path}/parts")
    return parts


def read_sketches(spark: SparkSession, archive_path: str) -> Sketches | None:
    """The sketches of an archive, or None for one that was written without (by a stream, for example)."""
    path = sketch_path(archive_path)
    try:
        return Sketches(spark.read.schema(PARTS).parquet(f"{path}/parts"), spark.read.schema(BLOCKS).parquet(f"{path}/blocks"))
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise
