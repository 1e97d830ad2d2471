"""Compaction of an archive: small files of a partition are merged, and readers see the old or the new ones.

A run plans by file size, from a listing: it takes the partitions whose files are many and small, writes their rows into a
segment beside the partitions, and publishes one list that names the segment and the files it replaces. Readers leave those
out by name before they are opened. Rows appended later are further files and not concerned. Replaced
files are deleted by ``expire``, when readers of the older list are done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quaymaster.operators.membership import PARTITION
from quaymaster.session import materialise
from quaymaster.sinks.segments import SegmentTable

TARGET_BYTES = 128 << 20  # of a file
LEAST_FILES = 2  # of a partition that is worth a rewrite


def merges(spark: SparkSession, path: str) -> SegmentTable:
    """The published merges of an archive; Spark takes no folder that begins with an underscore for data."""
    return SegmentTable(spark, f"{path}/_compact")


def _published(table: SegmentTable) -> list[dict]:
    newest = table.newest()
    return [] if newest is None else table.segments(newest)


def visible(spark: SparkSession, path: str, folder: DataFrame) -> DataFrame:
    """What readers see of an archive: its ``folder`` without the replaced files, and the segments that replace them."""
    published = _published(merges(spark, path))
    if not published:
        return folder
    replaced = [name for s in published for name in s["replaced"]]
    kept = folder.where(~F.col("_metadata.file_name").isin(replaced)) if replaced else folder
    return kept.unionByName(merges(spark, path).read(published, folder.schema))


def file_sizes(rows: DataFrame) -> DataFrame:
    """(event_date, event_hour, file, bytes) of the files of a scan; reads no column of theirs."""
    return rows.select(*PARTITION, F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes")).groupBy(
        *PARTITION, "file").agg(F.max("bytes").alias("bytes"))


def plan(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Partitions to merge, with their number of files after it: those with fewer files if none were smaller than they could be."""
    return files.groupBy(*PARTITION).agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.collect_list("file").alias("names")
    ).withColumn("merged", F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)).cast("int")).where(
        (F.col("files") >= LEAST_FILES) & (F.col("files") > F.col("merged")))


def compact(folder: DataFrame, path: str, event_id: str, target_bytes: int = TARGET_BYTES) -> int:
    """Merge what the plan takes of an archive's ``folder`` scan; returns how many files were replaced.

    The driver handles names of small files, which are as many as a run replaces.
    """
    spark = folder.sparkSession
    table = merges(spark, path)
    before = _published(table)
    known = [name for s in before for name in s["replaced"]]
    here = folder.where(~F.col("_metadata.file_name").isin(known)) if known else folder
    chosen = materialise(plan(file_sizes(here), target_bytes), "compaction-plan")
    names = [r["name"] for r in chosen.select(F.explode("names").alias("name")).toLocalIterator()]
    if not names:
        return 0
    rows = here.where(F.col("_metadata.file_name").isin(names)).join(chosen.select(*PARTITION, "merged"), PARTITION)
    part = F.pmod(F.xxhash64(event_id), F.col("merged"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = rows.repartition(tasks, *PARTITION, part).select(*folder.columns)
    version = 0 if table.newest() is None else table.newest() + 1
    table.publish(version, before + [{**table.write(merged, version, partition_by=PARTITION), "replaced": names}])
    return len(names)


def expire(spark: SparkSession, path: str, folder: DataFrame) -> int:
    """Delete the replaced files and publish a list without their names; for when readers of older lists are done."""
    table = merges(spark, path)
    published = _published(table)
    replaced = {name for s in published for name in s["replaced"]}
    if not replaced:
        return 0
    where = folder.where(F.col("_metadata.file_name").isin(list(replaced))).select(F.col("_metadata.file_path").alias("file")).distinct()
    paths = [r["file"] for r in where.toLocalIterator()]
    for file in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, False)
    table.publish(table.newest() + 1, [{**s, "replaced": []} for s in published])
    return len(paths)
