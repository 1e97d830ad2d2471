"""Tables of immutable segments under a published list.

A segment is a folder of Parquet files that is written once. A version is a small file that lists segments with
their attributes. Readers open the newest version and see exactly its segments; writers add segments and then publish the
next list by one rename, which happens whole or not at all. A writer that repeats a version replaces its list, and what the
failed attempt had written is never listed. So several folders can change together, and readers see all of the change or none.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T


# Segments lie side by side as partitions of one folder, so that several with partitions of their own are one scan.
SEGMENT = "_segment"


@dataclass(frozen=True)
class SegmentTable:
    spark: SparkSession
    base: str

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        return self._path(self.base).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _list_path(self, version: int) -> str:
        return f"{self.base}/versions/v{version:012d}.json"

    def segment_path(self, segment: dict) -> str:
        return f"{self.base}/segments/{SEGMENT}={segment['name']}"

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        folder = self._path(f"{self.base}/versions")
        if not self._files().exists(folder):
            return []
        names = [f.getPath().getName() for f in self._files().listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def newest(self) -> int | None:
        found = self.versions()
        return found[-1] if found else None

    def segments(self, version: int) -> list[dict]:
        """The list of a version: a few entries of some hundred bytes."""
        return json.loads(self.spark.read.text(self._list_path(version), wholetext=True).first()[0])

    def write(
        self, rows: DataFrame, version: int, measures: dict[str, Column] | None = None, partition_by: list[str] | None = None, **attributes,
    ) -> dict:
        """Write a segment for a version that is to be published.

        Its entry holds ``attributes``, the number of rows, and ``measures`` of them, which are taken while they are written.
        """
        entry = {"name": f"v{version:012d}-{uuid.uuid4().hex}", **attributes}
        seen = Observation(entry["name"])
        found = [F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in (measures or {}).items()]]
        rows.observe(seen, *found).write.partitionBy(*(partition_by or [])).parquet(self.segment_path(entry))
        return {**entry, **seen.get}

    def publish(self, version: int, segments: list[dict]) -> None:
        """Make ``segments`` the content of ``version``: the list is written aside and renamed over."""
        target, aside = self._list_path(version), f"{self.base}/versions/.{uuid.uuid4().hex}"
        out = self._files().create(self._path(aside))
        out.write(bytearray(json.dumps(segments).encode()))
        out.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        how = gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(target).toUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(self._path(aside), self._path(target), how)

    def read(self, segments: list[dict], schema: T.StructType, *more: str) -> DataFrame:
        """Rows of segments; ``more`` are columns of the scan itself, such as the name of the file."""
        if not segments:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.base}/segments")
        return reader.parquet(*[self.segment_path(s) for s in segments]).select(*schema.names, *more)

    def clean(self, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` versions, and the segments written for deleted or kept versions that none of the kept lists.

        A repeat of the newest version reads the one before it, which is kept. Readers of older versions have to be done.
        """
        found = self.versions()
        if not found:
            return
        listed = {s["name"] for v in found[-keep:] for s in self.segments(v)}
        for old in found[:-keep]:
            self._files().delete(self._path(self._list_path(old)), False)
        for folder in self._files().listStatus(self._path(f"{self.base}/segments")):
            name = folder.getPath().getName().removeprefix(f"{SEGMENT}=")
            if name not in listed and int(name[1:13]) <= found[-1]:
                self._files().delete(folder.getPath(), True)
