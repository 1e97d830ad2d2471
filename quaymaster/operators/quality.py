"""Business rules, volumes, freshness and archive checks."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quaymaster.functions import bands
from quaymaster.functions.scalars import age_seconds, is_uuid, moment, ratio, size_mb

# Priorities, staleness limit in seconds, archive thresholds in megabytes.
PRIORITIES = ["HIGH", "NORMAL", "LOW"]
STALE_SECONDS = 120
ARCHIVE_THRESHOLD_MB = 300
DEMO_THRESHOLD_MB = 30


@dataclass(frozen=True)
class Rule:
    """A rule and the condition under which a row breaks it."""

    name: str
    violated: Column


def fails(valid: Column) -> Column:
    """A condition that a missing value does not meet either."""
    return ~F.coalesce(valid, F.lit(False))


def orders_rules(id_column: str = "order_id") -> list[Rule]:
    return [
        Rule("fulfilled_within_requested", F.col("fulfilled_qty") > F.col("requested_qty")),
        Rule("lost_is_requested_minus_fulfilled",
             F.col("lost_sales_qty") != F.col("requested_qty") - F.col("fulfilled_qty")),
        Rule("order_value_not_negative", F.col("order_value") < 0),
        Rule("priority_known", fails(F.col("priority_level").isin(PRIORITIES))),
        Rule("order_id_is_uuid", fails(is_uuid(F.col(id_column)))),
    ]


def inventory_rules(id_column: str = "inventory_event_id") -> list[Rule]:
    return [
        Rule("on_hand_not_negative", F.col("on_hand_qty") < 0),
        Rule("inventory_id_is_uuid", fails(is_uuid(F.col(id_column)))),
    ]


def shipments_rules(id_column: str = "shipment_id") -> list[Rule]:
    return [
        Rule("arrival_not_before_expected", F.col("actual_arrival_ts") < F.col("expected_arrival_ts")),
        Rule("quantity_positive", F.col("quantity") <= 0),
        Rule("shipment_id_is_uuid", fails(is_uuid(F.col(id_column)))),
    ]


def range_rule(name: str, column: str, low, high) -> Rule:
    return Rule(name, ~F.col(column).between(low, high))


def check_rules(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """(table, rule, checked, violations) of one table, in one pass over it."""
    counts = df.agg(F.count("*").alias("_checked"), *[F.count_if(r.violated).alias(r.name) for r in rules])
    return counts.unpivot("_checked", [r.name for r in rules], "rule", "violations").select(
        F.lit(table).alias("table_name"), "rule", F.col("_checked").alias("checked"), "violations"
    )


@dataclass(frozen=True)
class Reference:
    """A key of a fact that has to be in a dimension."""

    key: str
    dimension: DataFrame
    dimension_key: str | None = None

    @property
    def rule(self) -> str:
        return f"{self.key}_exists"


def check_references(fact: DataFrame, table: str, references: list[Reference]) -> DataFrame:
    """(table, rule, checked, violations) for all keys of a fact: rows whose key its dimension lacks.

    One pass over the fact and one exchange: every row gives one (rule, key) for each reference, which are counted on the map
    side, so a hot key reaches the exchange as one row a task. The keys of all dimensions are one table, joined once.
    """
    spark = fact.sparkSession
    text = lambda column: F.col(column).cast("string")
    pairs = F.array(*[F.struct(F.lit(r.rule).alias("rule"), text(r.key).alias("key")) for r in references])
    counted = fact.select(F.explode(pairs).alias("r")).select("r.*").where("key IS NOT NULL").groupBy("rule", "key").agg(
        F.count("*").alias("rows"))
    known = reduce(DataFrame.unionByName, [
        r.dimension.select(F.lit(r.rule).alias("rule"), text(r.dimension_key or r.key).alias("key")) for r in references
    ]).distinct().withColumn("known", F.lit(True))
    checked = counted.join(known, ["rule", "key"], "left").groupBy("rule").agg(
        F.sum("rows").alias("checked"), F.sum(F.when(F.col("known").isNull(), F.col("rows"))).alias("violations"))
    rules = spark.range(1).select(F.explode(F.array(*[F.lit(r.rule) for r in references])).alias("rule"))
    nought = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return rules.join(checked, "rule", "left").select(F.lit(table).alias("table_name"), "rule", nought("checked"), nought("violations"))


def check_reference(
    fact: DataFrame, table: str, dimension: DataFrame, key: str, dimension_key: str | None = None
) -> DataFrame:
    """``check_references`` for one key."""
    return check_references(fact, table, [Reference(key, dimension, dimension_key)])


# Rules inside a pass that writes -------------------------------------------------------


def observed_rules(rules: list[Rule]) -> list[Column]:
    """Measures for ``DataFrame.observe``: rows, and rows that break each rule. They cost no scan of their own."""
    return [F.count(F.lit(1)).alias("checked"), *[F.count_if(r.violated).alias(r.name) for r in rules]]


def broken_rules(rules: list[Rule]) -> Column:
    """Names of the rules that a row breaks; empty for a sound row."""
    none = F.array().cast("array<string>")
    return F.concat(none, *[F.when(r.violated, F.array(F.lit(r.name))).otherwise(none) for r in rules])


def breaks_any(rules: list[Rule]) -> Column:
    """Whether a row breaks one of the rules."""
    return reduce(Column.__or__, [F.coalesce(r.violated, F.lit(False)) for r in rules], F.lit(False))


def rule_report(spark: SparkSession, table: str, measures: dict, rules: list[Rule]) -> DataFrame:
    """(table, rule, checked, violations) from the measures of ``observed_rules``: one row for each rule."""
    rows = [(table, r.name, measures.get("checked", 0), measures.get(r.name, 0)) for r in rules]
    return spark.createDataFrame(rows, "table_name string, rule string, checked bigint, violations bigint")


def quality_report(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# Volumes -----------------------------------------------------------------------


def volume_report(tables: dict[str, DataFrame], threshold_mb: float = ARCHIVE_THRESHOLD_MB) -> DataFrame:
    """Rows, estimated size and progress towards the archive threshold per table."""
    counts = reduce(
        DataFrame.unionByName,
        [df.agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit(n)) for n, df in tables.items()],
    )
    size = size_mb(F.col("row_count"))
    return counts.select(
        "table_name", "row_count", size.alias("size_mb"),
        F.round(size / F.lit(float(threshold_mb)) * 100, 1).alias("progress_pct"),
    )


def archive_needed(volumes: DataFrame, threshold_mb: float = ARCHIVE_THRESHOLD_MB) -> DataFrame:
    """Whether the estimated size of all tables exceeds the threshold."""
    size = size_mb(F.col("row_count"))
    return volumes.agg(F.sum("row_count").alias("row_count")).select(
        "row_count", size.alias("size_mb"), F.lit(float(threshold_mb)).alias("threshold_mb"),
        F.round(size / F.lit(float(threshold_mb)) * 100, 1).alias("progress_pct"),
        F.when(size > threshold_mb, "trigger_archival").otherwise("skip_archival").alias("decision"),
    )


def archive_effect(before: DataFrame, after: DataFrame) -> DataFrame:
    """Size before and after an archive run, and what it freed."""
    kept = after.agg(F.count("*")).scalar()
    rows = before.agg(F.count("*").alias("rows_before")).select("rows_before", kept.alias("rows_after"))
    first, last = size_mb(F.col("rows_before")), size_mb(F.col("rows_after"))
    return rows.select(
        "rows_before", "rows_after", first.alias("size_before_mb"), last.alias("size_after_mb"),
        F.round(first - last, 2).alias("freed_mb"),
        F.round(ratio(first - last, first) * 100, 1).alias("freed_pct"),
    )


# Freshness ----------------------------------------------------------------------


def fact_freshness(facts: dict[str, tuple[DataFrame, str]], as_of: datetime, watched: str = "orders_fact") -> DataFrame:
    """Age of the newest row of each fact; only the watched fact can be stale."""
    now = moment(as_of, "timestamp_ntz")
    newest = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.max(ts).cast("timestamp_ntz").alias("newest")).withColumn("table_name", F.lit(name))
            for name, (df, ts) in facts.items()
        ],
    )
    age = age_seconds(F.col("newest"), now)
    stale = (F.col("table_name") == watched) & (age > STALE_SECONDS)
    return newest.select("table_name", age.alias("age_seconds"), F.coalesce(stale, F.lit(False)).alias("stale"))


def kpi_freshness(updates: DataFrame, as_of: datetime, limit: int = STALE_SECONDS) -> DataFrame:
    """Fresh, Stale or Unknown for each ``last_update`` text."""
    age = age_seconds(F.try_to_timestamp(F.col("last_update")), moment(as_of, "timestamp_ntz"))
    return updates.withColumn("age_seconds", age).withColumn("freshness", bands.freshness(age, limit))


def kpi_availability(serving: DataFrame, keys: list[str]) -> DataFrame:
    """Whether any of the KPIs has records."""
    return serving.where(F.col("kpi_key").isin(keys)).agg(
        F.count_distinct("kpi_key").alias("available_kpis"), (F.count("*") > 0).alias("has_data")
    )
