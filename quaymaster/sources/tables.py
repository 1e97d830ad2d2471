"""Scans with explicit schemas and the time filters on top of them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quaymaster import schemas
from quaymaster.functions.scalars import instant
from quaymaster.sinks.compaction import visible

# Analysis window and lookback of the KPI job, in minutes.
ANALYSIS_MINUTES = 15
LOOKBACK_MINUTES = 30


@dataclass(frozen=True)
class Period:
    """A rolling window that ends at ``as_of``."""

    as_of: datetime
    minutes: float = ANALYSIS_MINUTES

    @property
    def start(self) -> datetime:
        return self.as_of - timedelta(minutes=self.minutes)

    @property
    def days(self) -> float:
        return self.minutes / (24.0 * 60.0)


def scan(
    spark: SparkSession, schema: T.StructType, path: str | None = None, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Read a table with a declared schema; connectors take their options instead of a path."""
    reader = spark.read.format(fmt).schema(schema).options(**options)
    return reader.load(path) if path else reader.load()


def scan_stream(spark: SparkSession, schema: T.StructType, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Files dropped into a folder as an unbounded table."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def scan_archive(
    spark: SparkSession, base: str, table: str, start: datetime | None = None, end: datetime | None = None,
    schema: T.StructType | None = None, ts: str | None = None,
) -> DataFrame:
    """Archive partitions of one fact that can hold rows of ``[start, end)``.

    Bounds go to the partition column for pruning and to the event time for exactness.
    """
    ts = ts or schemas.FACT_TIME[table]
    full = schemas.archived(schema or schemas.TABLES[table])
    df = visible(spark, f"{base}/{table}", spark.read.schema(full).parquet(f"{base}/{table}"))
    if start is not None:
        df = df.where((F.col("event_date") >= F.lit(start.date())) & (F.col(ts) >= instant(df, ts, start)))
    if end is not None:
        df = df.where((F.col("event_date") <= F.lit(end.date())) & (F.col(ts) < instant(df, ts, end)))
    return df


def recent(df: DataFrame, ts: str, period: Period) -> DataFrame:
    """Rows at or after the start of the period."""
    out = df.where(F.col(ts) >= instant(df, ts, period.start))
    if "event_date" in df.columns:
        out = out.where(F.col("event_date") >= F.lit(period.start.date()))
    return out


def older_than(df: DataFrame, ts: str, cutoff: datetime) -> DataFrame:
    """Rows strictly before the cutoff."""
    return df.where(F.col(ts) < instant(df, ts, cutoff))


def newest_time(df: DataFrame, ts: str) -> datetime | None:
    """Largest event time in UTC, as a driver value: one row of one column."""
    return df.agg(F.max(ts).cast("timestamp_ntz")).first()[0]


def latest_record(df: DataFrame, ts: str, tie: list[str]) -> DataFrame:
    """The newest row as a one-row frame; partial aggregation, no sort."""
    best = F.max_by(F.struct(*df.columns), F.struct(ts, *tie)).alias("row")
    return df.agg(best).where(F.col("row").isNotNull()).select("row.*")


def keep_latest(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key, the last by ``order``; combines on the map side."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("row")
    return df.groupBy(*keys).agg(best).select(*keys, "row.*").select(*df.columns)


def replace_table(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Replace a dimension with the given rows, cast to its schema."""
    df.select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.mode("overwrite").parquet(path)
