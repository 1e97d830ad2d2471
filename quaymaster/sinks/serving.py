"""The serving table: KPI records as JSON under a key, with an expiry.

Each record is a row of its own, so a KPI with many records is written and read by
many tasks. Every run publishes a new version; readers see whole versions only.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from quaymaster import schemas
from quaymaster.functions.scalars import moment
from quaymaster.sinks.versions import drop_versions, read_version, write_version

# Keys, record limits and time to live of the published KPIs.
TTL_SECONDS = 120
INVENTORY_KEY = "kpi:inventory_level"
STOCKOUT_KEY = "kpi:stockout_alerts"
SUPPLIER_KEY = "kpi:supplier_performance"
UTILIZATION_KEY = "kpi:dc_utilization"
REGIONAL_KEY = "kpi:regional_performance"
LAST_UPDATE_KEY = "kpi:last_update"
WINDOW_KEY = "kpi:analysis_window_minutes"
STOCKOUT_COUNT_KEY = "kpi:stockout_risk_count"
OVERLOADED_COUNT_KEY = "kpi:dc_overloaded_count"


def _stamped(df: DataFrame, as_of: datetime, ttl: int) -> DataFrame:
    return df.withColumn("updated_at", moment(as_of)).withColumn(
        "expires_at", moment(as_of + timedelta(seconds=ttl))
    )


def records(df: DataFrame, key: str, order: list, as_of: datetime, limit: int | None = None,
            ttl: int = TTL_SECONDS) -> DataFrame:
    """Records of one KPI. A limited KPI is a top list and numbers its records; an unlimited one
    carries its sort order in the payload and has no position, which would need one task."""
    payload = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("payload")
    if limit is None:
        rows = df.select(F.lit(None).cast("bigint").alias("position"), payload)
    else:
        numbered = df.orderBy(*order).limit(limit).withColumn("_pos", F.row_number().over(Window.orderBy(*order)))
        rows = numbered.select(F.col("_pos").cast("bigint").alias("position"), payload)
    return _stamped(rows.select(F.lit(key).alias("kpi_key"), "position", "payload"), as_of, ttl)


def counter(value: DataFrame, key: str, as_of: datetime, ttl: int = TTL_SECONDS) -> DataFrame:
    """A one-row, one-column frame as a plain value under a key."""
    only = F.col(value.columns[0]).cast("string").alias("payload")
    return _stamped(value.select(F.lit(key).alias("kpi_key"), F.lit(1).cast("bigint").alias("position"), only), as_of, ttl)


def metadata(spark: SparkSession, as_of: datetime, minutes: float, ttl: int = TTL_SECONDS) -> DataFrame:
    """Time and window of the run."""
    rows = [(LAST_UPDATE_KEY, 1, as_of.isoformat()), (WINDOW_KEY, 1, f"{minutes:g}")]
    return _stamped(spark.createDataFrame(rows, "kpi_key string, position bigint, payload string"), as_of, ttl)


def serving_table(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def version_of(as_of: datetime) -> int:
    """Version number of a run: milliseconds of its time."""
    return int(as_of.replace(tzinfo=as_of.tzinfo or timezone.utc).timestamp() * 1000)


def write_serving(table: DataFrame, path: str, version: int, keep: int = 2) -> None:
    """Publish a version, then name it as published, then drop all but the newest ``keep``.

    A reader that has opened an earlier version is served until its files expire with it.
    """
    spark = table.sparkSession
    write_version(table, f"{path}/data", version)
    spark.range(1).select(F.lit(version).cast("bigint").alias("version")).write.mode("overwrite").parquet(f"{path}/published/v{version:015d}")
    drop_versions(spark, f"{path}/data", keep)


def read_serving(spark: SparkSession, path: str) -> DataFrame:
    """The newest published version."""
    newest = spark.read.schema("version bigint").option("recursiveFileLookup", "true").parquet(f"{path}/published").agg(F.max("version")).first()[0]
    return read_version(spark, f"{path}/data", newest, schemas.SERVING)


def live(table: DataFrame, as_of: datetime) -> DataFrame:
    """Records that have not expired."""
    return table.where(F.col("expires_at") > moment(as_of))


def read_records(table: DataFrame, key: str, schema: T.StructType | str, as_of: datetime) -> DataFrame:
    """The live records of one KPI with their columns."""
    rows = live(table, as_of).where(F.col("kpi_key") == key)
    return rows.select("position", F.from_json("payload", schema).alias("r")).select("position", "r.*")


def read_values(table: DataFrame, keys: list[str], as_of: datetime) -> DataFrame:
    """Plain values: a JSON scalar is unwrapped, any other text is returned as it is."""
    text = F.col("payload")
    parsed = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "v string")["v"]
    return live(table, as_of).where(F.col("kpi_key").isin(keys)).select(
        "kpi_key", F.coalesce(parsed, text).alias("value")
    )
