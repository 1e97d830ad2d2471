"""Spark session settings and the shared folder for checkpoints and tables."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # An archive has a folder for every hour; listing them takes a task for each by default.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITION_BYTES = 4 << 20  # of input files, for each partition of a shuffle before small ones are merged
SPLIT_SETTING, DEFAULT_SPLIT, SPLIT_BYTES = "spark.sql.files.maxPartitionBytes", "134217728b", "16777216b"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "quaymaster", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC, ANSI arithmetic and adaptive execution.

    Shuffle partitions are left to the cluster configuration: adaptive
    execution coalesces small partitions and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir``, or else the session's checkpoint folder.

    Where neither is set it is a folder of the warehouse, which the executors share as well.
    """
    root = (
        spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    )
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def run_root(spark: SparkSession) -> str:
    """The folder of this application below the shared one."""
    return f"{shared_root(spark)}/quaymaster/{spark.sparkContext.applicationId}"


_SCOPE: ContextVar[str] = ContextVar("scope", default="")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder of this run and scope, never used before."""
    return f"{run_root(spark)}{_SCOPE.get()}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """What is written to the shared folder inside is deleted at the end; for a job whose results are elsewhere by then.

    Gives a ``materialise`` that writes outside, for what is to stay.
    """
    outer = _SCOPE.get()
    token = _SCOPE.set(f"{outer}/scope-{uuid.uuid4().hex}")
    folder = run_root(spark) + _SCOPE.get()

    def keep(df: DataFrame, label: str) -> DataFrame:
        inner = _SCOPE.set(outer)
        try:
            return materialise(df, label)
        finally:
            _SCOPE.reset(inner)

    try:
        yield keep
    finally:
        _SCOPE.reset(token)
        delete_folder(spark, folder)


def free_driver(spark: SparkSession) -> None:
    """Let the driver give up what finished jobs have left, such as plans, broadcast tables and records of shuffles.

    Spark cleans these up once garbage collection finds their frames unused; a chain of large stages fills the heap before.
    """
    gc.collect()
    spark._jvm.System.gc()


_STAGES: dict[str, str] = {}


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """For a chain of stages that each write their result: what a stage writes inside is deleted when the next stage begins.

    The frame that a stage returns may read it until then.
    """
    app = spark.sparkContext.applicationId
    if app in _STAGES:
        delete_folder(spark, _STAGES.pop(app))
        free_driver(spark)
    token = _SCOPE.set(f"{_SCOPE.get()}/stage-{uuid.uuid4().hex}")
    _STAGES[app] = run_root(spark) + _SCOPE.get()
    try:
        yield
    finally:
        _SCOPE.reset(token)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def folder_exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def move_folder(spark: SparkSession, folder: str, target: str) -> None:
    """Rename a folder, unless another writer has put the target there first; an empty folder stands for one never written."""
    source, path = (spark._jvm.org.apache.hadoop.fs.Path(f) for f in (folder, target))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path.getParent())
    files.mkdirs(source)
    if not files.exists(path):
        files.rename(source, path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this run has written to the shared folder; for the end of a run, when its results are out."""
    delete_folder(spark, run_root(spark))


def size_tasks(spark: SparkSession, input_bytes: int) -> None:
    """Let the number of tasks follow the input, so that what a task sorts or groups does not grow with the table.

    Adaptive execution merges the partitions of small shuffles again. A larger number that is set already stays.
    """
    start = int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(INITIAL_PARTITIONS, str(max(start, -(-input_bytes // PARTITION_BYTES))))
    if spark.conf.get(SPLIT_SETTING, DEFAULT_SPLIT) == DEFAULT_SPLIT:
        spark.conf.set(SPLIT_SETTING, SPLIT_BYTES)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Cuts lineage so that a lost executor costs a re-read, not a recompute, and
    so that values fixed at write time (such as a partition number) stay fixed. The shuffle files of
    the write are deleted when it ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_deleted(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write inside are deleted when it ends; by default they stay until the driver collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
