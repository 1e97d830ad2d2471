"""Hot facts clustered by time, with the times of every file on the published list.

An append sorts its rows into ranges of time, one for each file, and notes the first and last time of each file in the list. A scan
of a period picks the files that overlap it from the list, before any file is listed or opened, and filters what is left exactly.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quaymaster.functions.scalars import instant
from quaymaster.sinks.segments import SegmentTable

EPOCH = datetime(1970, 1, 1)


def micros(at: datetime) -> int:
    return (at.replace(tzinfo=None) - EPOCH) // timedelta(microseconds=1)


@dataclass(frozen=True)
class HotTable:
    """A fact of ``schema`` with event time ``ts`` below ``base``. Times without zone are UTC."""

    spark: SparkSession
    base: str
    schema: T.StructType
    ts: str

    @property
    def table(self) -> SegmentTable:
        return SegmentTable(self.spark, self.base)

    def _listed(self) -> list[dict]:
        newest = self.table.newest()
        return [] if newest is None else self.table.segments(newest)

    def files(self) -> list[dict]:
        """Name, rows, first and last time of every file; as many entries as the table has files."""
        return [{**f, "segment": s["name"]} for s in self._listed() for f in s["files"]]

    def append(self, rows: DataFrame, files: int | None = None) -> None:
        """Publish further rows, in files of consecutive times: as many as their size asks for, or ``files``."""
        table, before = self.table, self._listed()
        version = 0 if table.newest() is None else table.newest() + 1
        rows = rows.select(*self.schema.names)
        ranges = rows.repartitionByRange(self.ts) if files is None else rows.repartitionByRange(files, self.ts)
        ordered = ranges.sortWithinPartitions(self.ts)
        entry = table.write(ordered, version)
        at = F.unix_micros(F.col(self.ts).cast("timestamp"))
        found = table.read([entry], self.schema, "_metadata.file_name").groupBy("file_name").agg(
            F.count("*").alias("rows"), F.min(at).alias("first"), F.max(at).alias("last"))
        files = [{"file": r["file_name"], "rows": r["rows"], "first": r["first"], "last": r["last"]} for r in found.collect()]
        table.publish(version, before + [{**entry, "files": files}])
        table.clean()

    def _read(self, files: list[dict]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.table.segment_path({'name': f['segment']})}/{f['file']}" for f in files]
        reader = self.spark.read.schema(self.schema).option("basePath", f"{self.base}/segments")
        return reader.parquet(*paths).select(*self.schema.names)

    def scan(self, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """Rows of ``[start, end)`` from the files that can hold some; all rows, those without time too, if both are open."""
        picked = self.files()
        if start is not None:
            picked = [f for f in picked if f["last"] is not None and f["last"] >= micros(start)]
        if end is not None:
            picked = [f for f in picked if f["first"] is not None and f["first"] < micros(end)]
        rows = self._read(picked)
        if start is not None:
            rows = rows.where(F.col(self.ts) >= instant(rows, self.ts, start))
        return rows if end is None else rows.where(F.col(self.ts) < instant(rows, self.ts, end))

    def retire(self, cutoff: datetime) -> int:
        """Take the files that end before ``cutoff`` off the list, after their rows are archived; returns how many."""
        table, kept, gone = self.table, [], 0
        for segment in self._listed():
            files = [f for f in segment["files"] if f["last"] is None or f["last"] >= micros(cutoff)]
            gone += len(segment["files"]) - len(files)
            kept += [{**segment, "files": files}] if files else []
        if gone:
            table.publish(table.newest() + 1, kept)
            table.clean()
        return gone
