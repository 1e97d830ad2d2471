"""Numbered versions of a table: readers see a whole version, a rerun rewrites the same one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def version_path(base: str, version: int) -> str:
    return f"{base}/version={version:012d}"


def write_version(df: DataFrame, base: str, version: int) -> None:
    df.write.mode("overwrite").parquet(version_path(base, version))


def read_version(spark: SparkSession, base: str, version: int, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(version_path(base, version))


def drop_versions(spark: SparkSession, base: str, keep: int) -> None:
    """Delete all versions but the newest ``keep``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for old in sorted(f.getPath().toString() for f in files.listStatus(path))[: -keep]:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(old), True)
