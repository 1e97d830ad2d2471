"""Partitioned Parquet archive with manifest and retention.

One cutoff is computed per run and used for archiving and for deleting. A row is
appended only if its id is not yet in the archive, and deleted only if it is, so a
run may be repeated or may fail in between without losing or doubling rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from quaymaster import schemas
from quaymaster.functions.scalars import MEGABYTE, RECORD_BYTES, date_parts, instant, iso_text
from quaymaster.operators.membership import count_parts, not_archived
from quaymaster.operators.quality import Rule, breaks_any, broken_rules, observed_rules, rule_report
from quaymaster.operators.setops import one_of_each
from quaymaster.session import materialise, scratch_scope, shuffles_deleted
from quaymaster.sinks import compaction
from quaymaster.sinks.compaction import TARGET_BYTES, visible
from quaymaster.sinks.sketches import read_sketches, write_sketches
from quaymaster.sources.tables import older_than

# Archive policy.
OLDER_THAN_MINUTES = 120
PARTITION_COLUMNS = ["event_date", "event_hour"]

FILE_ROWS = 1_000_000  # rows of a partition that one task writes
TASK_ROWS = 200_000  # mean rows of a task that sorts rows by partition and id
SLICE_ROWS = 40_000_000  # mean rows that are shuffled at once, as shuffle files lie on disk beside the due rows and the archive


@dataclass(frozen=True)
class ArchiveTable:
    """A fact to archive. ``closed`` limits it to rows that will not change any more; ``rules`` are checked as rows are written."""

    name: str
    rows: DataFrame
    ts: str
    event_id: str
    closed: Column | None = None
    rules: tuple[Rule, ...] = ()


def cutoff_of(as_of: datetime, minutes: int = OLDER_THAN_MINUTES) -> datetime:
    return as_of - timedelta(minutes=minutes)


def with_date_parts(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns(date_parts(F.col(ts)))


def due_rows(table: ArchiveTable, cutoff: datetime) -> DataFrame:
    due = older_than(table.rows, table.ts, cutoff)
    return due if table.closed is None else due.where(table.closed)


def _read(spark: SparkSession, path: str, fields) -> DataFrame | None:
    try:
        return spark.read.schema(schemas.T.StructType(list(fields))).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise


def read_archive(spark: SparkSession, path: str, columns) -> DataFrame | None:
    """The archive of one fact with its published merges, or None before its first run."""
    folder = archive_folder(spark, path, columns)
    return None if folder is None else visible(spark, path, folder)


def archive_folder(spark: SparkSession, path: str, columns) -> DataFrame | None:
    """The files below an archive's partitions, merged or not."""
    return _read(spark, path, list(columns) + schemas.ARCHIVE_PARTS.fields)


def spread(due: DataFrame, event_id: str, counts: DataFrame, part: int = 0, parts: int = 1) -> DataFrame:
    """Rows by partition, each id once, a busy hour dealt to as many tasks as its rows (``counts.ids``) fill files.

    The tasks are fixed in number by the rows, as merging small partitions would leave the opening of
    their files to one task. Rows of one id meet in a task, so they are deduplicated without a further exchange. Of
    several ``parts``, one has the rows of some files, wholly.
    """
    files = counts.select(*PARTITION_COLUMNS, F.ceil(F.col("ids") / FILE_ROWS).alias("_files"))
    dealt = due.join(files, PARTITION_COLUMNS).withColumn("_part", F.pmod(F.xxhash64(event_id), F.col("_files")))
    by_task = [*PARTITION_COLUMNS, "_part"]
    if parts > 1:
        dealt = dealt.where(F.pmod(F.xxhash64(F.lit("part"), *by_task), F.lit(parts)) == part)
    tasks = max(int(due.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows_of(counts) // (TASK_ROWS * parts)))
    return one_of_each(dealt.repartition(tasks, *by_task), [*by_task, event_id]).select(*due.columns)


def rows_of(counts: DataFrame) -> int:
    return counts.agg(F.sum("ids")).first()[0] or 0


def append_new(table: ArchiveTable, base: str, cutoff: datetime) -> dict | None:
    """Append the due rows that are not archived yet, each id once; their statistics, or None if there are none.

    The due rows are evaluated and written once; counting, sketches and the archive read what was written. Ids are
    compared with the sketches of their own partitions, and with the archive only where those do not rule them out.
    Statistics and broken rules are observed per written row; rows that break a rule are also set apart (``read_broken``).
    What is written on the way is deleted at the end, so a run has it for one table at a time; a large append is shuffled and
    written in parts. One that fails between them has archived the files of some, and the next run appends the rest.
    """
    spark = table.rows.sparkSession
    with scratch_scope(spark), shuffles_deleted(spark):
        return _append_new(spark, table, base, cutoff)


def _append_new(spark: SparkSession, table: ArchiveTable, base: str, cutoff: datetime) -> dict | None:
    path = f"{base}/{table.name}"
    due = materialise(with_date_parts(due_rows(table, cutoff), table.ts), "due")
    known = read_archive(spark, path, table.rows.schema.fields)
    if known is not None:
        due = materialise(not_archived(due, table.event_id, known, read_sketches(spark, path)), "new")
    if due.isEmpty():
        return None
    counts = write_sketches(due, table.event_id, path) if known is None or read_sketches(spark, path) else None
    if counts is None:  # an archive without sketches stays so, as a part of them would hide what is older
        counts = materialise(count_parts(due, table.event_id, ""), "due-counts")
    if table.rules:
        broken = due.where(breaks_any(list(table.rules))).withColumn("broken_rules", broken_rules(list(table.rules)))
        broken.write.mode("append").parquet(broken_path(path))
    seen, parts = [], max(1, -(-rows_of(counts) // SLICE_ROWS))
    for part in range(parts):
        seen.append(Observation(f"archive-{table.name}-{part}"))
        (
            spread(due, table.event_id, counts, part, parts)
            .observe(
                seen[-1], F.count("*").alias("records"), iso_text(F.min(table.ts)).alias("first"), iso_text(F.max(table.ts)).alias("last"),
                *observed_rules(table.rules),
            )
            .write.mode("append").partitionBy(*PARTITION_COLUMNS).option("compression", "snappy").parquet(path)
        )
    stats = together([s.get for s in seen])
    return {
        "collection": table.name,
        "record_count": stats["records"],
        "size_mb": round(stats["records"] * RECORD_BYTES / MEGABYTE, 2),
        "date_range": {"min": stats["first"], "max": stats["last"]},
        "measures": {k: stats[k] for k in ["checked", *[r.name for r in table.rules]]},
    }


def together(seen: list[dict]) -> dict:
    """The measures of all parts of an append: first and last times, and the sums of what is counted."""
    times = {"first": min, "last": max}
    every = {k: [s[k] for s in seen if s[k] is not None] for k in seen[0]}
    return {k: times.get(k, sum)(found) if found or k not in times else None for k, found in every.items()}


def broken_path(archive_path: str) -> str:
    """Beside the partitions, where readers of the data do not look."""
    return f"{archive_path}/_broken"


def read_broken(spark: SparkSession, archive_path: str, columns, event_id: str) -> DataFrame | None:
    """Rows that broke a rule when they were archived, with ``broken_rules``; None if no rules were checked.

    They are written before the archive, so an append that failed and was repeated has left them twice.
    """
    rules = schemas.T.StructField("broken_rules", schemas.T.ArrayType(schemas.T.StringType()))
    found = _read(spark, broken_path(archive_path), [*columns, *schemas.ARCHIVE_PARTS.fields, rules])
    return None if found is None else found.dropDuplicates([event_id])


def retained(table: ArchiveTable, base: str, cutoff: datetime) -> DataFrame:
    """What stays hot: rows from the cutoff on, and earlier ones that the archive lacks."""
    limit = instant(table.rows, table.ts, cutoff)
    late = table.rows.where(F.col(table.ts) < limit)
    path = f"{base}/{table.name}"
    known = read_archive(table.rows.sparkSession, path, table.rows.schema.fields)
    if known is not None:
        dated = with_date_parts(late, table.ts)
        late = not_archived(dated, table.event_id, known, read_sketches(table.rows.sparkSession, path)).select(*table.rows.columns)
    return table.rows.where((F.col(table.ts) >= limit) | F.col(table.ts).isNull()).unionByName(late)


def stats_frame(spark: SparkSession, stats: list[dict]) -> DataFrame:
    """Statistics of a run: one row per archived table."""
    return spark.createDataFrame([{k: s[k] for k in schemas.ARCHIVE_STATS.names} for s in stats], schemas.ARCHIVE_STATS)


def write_rule_report(spark: SparkSession, tables: list[ArchiveTable], stats: list[dict], base: str) -> None:
    """Append (table, rule, checked, violations) of the rows that a run has archived."""
    measured = {s["collection"]: s["measures"] for s in stats}
    reports = [rule_report(spark, t.name, measured[t.name], t.rules) for t in tables if t.rules and t.name in measured]
    if reports:
        reduce(DataFrame.unionByName, reports).write.mode("append").json(f"{base}/rules")


def read_rule_report(spark: SparkSession, base: str) -> DataFrame:
    """Checked rows and violations of all runs."""
    rows = spark.read.schema("table_name string, rule string, checked bigint, violations bigint").json(f"{base}/rules")
    return rows.groupBy("table_name", "rule").agg(F.sum("checked").alias("checked"), F.sum("violations").alias("violations"))


def totals(stats: DataFrame) -> DataFrame:
    return stats.agg(
        F.sum("record_count").alias("total_records"), F.round(F.sum("size_mb"), 2).alias("total_size_mb")
    )


def manifest(stats: DataFrame, base: str, created_at: datetime, minutes: int = OLDER_THAN_MINUTES) -> DataFrame:
    """One row that describes a run. ``stats`` has one row per fact table."""
    return stats.agg(
        F.sort_array(F.collect_list(F.struct("collection", "record_count", "size_mb", "date_range"))).alias(
            "archived_collections"
        ),
        F.sum("record_count").alias("total_records"),
        F.round(F.sum("size_mb"), 2).alias("total_size_mb"),
    ).select(
        F.uuid().alias("archive_id"),
        F.lit(created_at.isoformat()).alias("created_at"),
        "archived_collections",
        "total_records",
        "total_size_mb",
        F.lit(base).alias("hdfs_base_path"),
        F.struct(
            F.lit(minutes).alias("older_than_minutes"),
            F.lit("parquet").alias("format"),
            F.lit("snappy").alias("compression"),
            F.array(*[F.lit(c) for c in PARTITION_COLUMNS]).alias("partitioned_by"),
        ).alias("archive_policy"),
    )


def write_manifest(frame: DataFrame, base: str) -> None:
    frame.write.mode("append").json(f"{base}/metadata")


def run_archive(
    spark: SparkSession, tables: list[ArchiveTable], base: str, as_of: datetime,
    minutes: int = OLDER_THAN_MINUTES, keep: Callable[[str, DataFrame], None] | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """Archive all tables, write the manifest, then hand over what stays hot.

    A table without due rows adds nothing and a failing one does not stop the others.
    ``keep(name, rows)`` stores the new hot version of a table and is called for every table, so
    the new version is complete and a delete that failed before is made up for; a table that could not be
    archived keeps all its rows. Returns the statistics and the errors by table.
    """
    cutoff = cutoff_of(as_of, minutes)
    stats, errors = [], {}
    for table in tables:
        try:
            done = append_new(table, base, cutoff)
        except Exception as failure:  # noqa: BLE001 - reported, and the other tables go on
            errors[table.name] = str(failure)
            continue
        if done:
            stats.append(done)
    frame = stats_frame(spark, stats)
    if stats:
        write_manifest(manifest(frame, base, as_of, minutes), base)
        write_rule_report(spark, tables, stats, base)
    if keep is not None:
        for table in tables:
            try:
                keep(table.name, table.rows if table.name in errors else retained(table, base, cutoff))
            except Exception as failure:  # noqa: BLE001 - the rows stay hot and in the archive
                errors[table.name] = str(failure)
    return frame, errors


def compact(spark: SparkSession, path: str, columns, event_id: str, target_bytes: int = TARGET_BYTES) -> int:
    """Merge the small files of an archive; returns how many files were replaced."""
    folder = archive_folder(spark, path, columns)
    return 0 if folder is None else compaction.compact(folder, path, event_id, target_bytes)


def expire_replaced(spark: SparkSession, path: str, columns) -> int:
    """Delete the files that merges have replaced; returns how many."""
    folder = archive_folder(spark, path, columns)
    return 0 if folder is None else compaction.expire(spark, path, folder)
