"""Normalised KPI frames and the frames behind the dashboard pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quaymaster.functions import bands
from quaymaster.functions.scalars import (
    compact_number, first_present, fixed, money_card, percent_text, ratio, thousands, to_number,
)

# Synonyms of each field, in order of preference.
INVENTORY_FIELDS = {
    "current_inventory": [
        "current_inventory", "total_inventory", "inventory", "on_hand_qty", "avg_on_hand_qty", "quantity",
    ],
    "safety_stock_level": [
        "safety_stock_level", "safety_stock", "safety_stock_qty", "min_stock", "reorder_point",
    ],
}
STOCKOUT_FIELDS = {
    "days_to_stockout": [
        "days_to_stockout", "days_until_stockout", "stockout_days", "tte", "days_to_stock_out",
    ],
}
SUPPLIER_FIELDS = {
    "avg_lead_time_days": ["avg_lead_time_days", "lead_time", "avg_lead_time", "lead_time_days"],
    "reliability_score": ["reliability_score", "reliability", "reliability_pct", "on_time_pct"],
    "performance_score": ["performance_score"],
}
UTILIZATION_FIELDS = {
    "utilization_rate": [
        "utilization_rate", "utilization", "dc_utilization", "utilization_pct", "util_rate",
    ],
}
REVENUE_FIELDS = {"total_revenue": ["total_revenue", "revenue", "total_sales", "sales"]}

# Fixed value: days assumed when the number of days is missing or malformed.
UNKNOWN_DAYS = 999.0


# Normalisation ----------------------------------------------------------------


def resolve_fields(df: DataFrame, fields: dict[str, list[str]], default: float = 0.0) -> DataFrame:
    """Add each field from its first present synonym as a number, or as the default."""
    resolved = {}
    for target, names in fields.items():
        source = first_present(df, names)
        resolved[target] = F.lit(float(default)) if source is None else to_number(source, default)
    return df.withColumns(resolved)


def fallback_name(df: DataFrame, name: str, key: str) -> DataFrame:
    """The name, or the id where the name is null or the column absent."""
    ident = F.col(key).cast("string")
    return df.withColumn(name, F.coalesce(F.col(name), ident) if name in df.columns else ident)


def percent_to_ratio(df: DataFrame, column: str) -> DataFrame:
    """Divide by 100 when any value exceeds 1. Off by default: an overloaded center is above 1."""
    top = df.agg(F.max(column)).scalar()
    return df.withColumn(column, F.when(top > 1, F.col(column) / 100).otherwise(F.col(column)))


def available_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def normalize_inventory(df: DataFrame) -> DataFrame:
    return resolve_fields(df, INVENTORY_FIELDS)


def normalize_stockout(df: DataFrame) -> DataFrame:
    out = resolve_fields(df, STOCKOUT_FIELDS, UNKNOWN_DAYS)
    out = fallback_name(fallback_name(out, "product_name", "sku_id"), "dc_name", "dc_id")
    for field in ("stock_level", "demand_rate_per_day"):
        if field in out.columns:
            out = out.withColumn(field, to_number(F.col(field)))
    return out.withColumn("severity", bands.alert_severity(F.col("days_to_stockout")))


def normalize_suppliers(df: DataFrame) -> DataFrame:
    return resolve_fields(df, SUPPLIER_FIELDS)


def normalize_utilization(df: DataFrame, rescale: bool = False) -> DataFrame:
    out = resolve_fields(df, UTILIZATION_FIELDS)
    return percent_to_ratio(out, "utilization_rate") if rescale else out


def normalize_regional(df: DataFrame) -> DataFrame:
    out = resolve_fields(df, REVENUE_FIELDS)
    return out.withColumn("total_orders", to_number(F.col("total_orders"))) if "total_orders" in df.columns else out


# Executive cards -----------------------------------------------------------------


def executive_totals(
    inventory: DataFrame, stockouts: DataFrame, suppliers: DataFrame, utilization: DataFrame, regional: DataFrame
) -> DataFrame:
    """One row: stock, alerts, unweighted mean lead time and utilisation, revenue."""
    return inventory.agg(F.coalesce(F.sum("current_inventory"), F.lit(0)).cast("bigint").alias("total_inventory")).select(
        "total_inventory",
        stockouts.agg(F.count("*")).scalar().alias("stockout_count"),
        F.coalesce(suppliers.agg(F.avg("avg_lead_time_days")).scalar(), F.lit(0.0)).alias("avg_lead_time_days"),
        F.coalesce(utilization.agg(F.avg("utilization_rate")).scalar() * 100, F.lit(0.0)).alias("avg_utilization_pct"),
        F.coalesce(regional.agg(F.sum("revenue")).scalar(), F.lit(0.0)).alias("total_revenue"),
    )


def executive_cards(totals: DataFrame) -> DataFrame:
    """Card texts with the colour bands of alerts and utilisation."""
    return totals.select(
        thousands(F.col("total_inventory")).alias("total_inventory"),
        F.col("stockout_count").cast("string").alias("stockout_alerts"),
        bands.traffic_light(F.col("stockout_count"), bands.ALERTS_DANGER, bands.ALERTS_WARNING).alias("stockout_colour"),
        fixed(F.col("avg_lead_time_days"), 1).alias("avg_lead_time"),
        percent_text(F.col("avg_utilization_pct")).alias("dc_utilization"),
        bands.traffic_light(
            F.col("avg_utilization_pct"), bands.DASHBOARD_CRITICAL_PCT, bands.DASHBOARD_HIGH_PCT
        ).alias("utilization_colour"),
        money_card(F.col("total_revenue")).alias("revenue"),
    )


# Pages -------------------------------------------------------------------------------


def revenue_share(regional: DataFrame, value: str = "revenue") -> DataFrame:
    total = regional.agg(F.sum(value)).scalar()
    return regional.select("region_id", "region_name", F.col(value), ratio(F.col(value), total).alias("revenue_share"))


def regional_view(regional: DataFrame) -> DataFrame:
    """Region cards: whole money and whole orders with thousands separators."""
    return regional.select(
        F.coalesce("region_name", F.col("region_id").cast("string"), F.lit("Unknown")).alias("region"),
        F.concat(F.lit("$"), thousands(F.col("revenue"))).alias("revenue"),
        F.concat(thousands(F.col("total_orders")), F.lit(" orders")).alias("orders"),
    )


def dc_status_view(utilization: DataFrame) -> DataFrame:
    percent = F.col("utilization_rate") * 100
    return utilization.select(
        "dc_id", "dc_name", percent.alias("utilization_pct"), percent_text(percent).alias("utilization_text"),
        bands.dc_badge(percent).alias("badge"),
    ).orderBy(F.desc("utilization_pct"), "dc_id")


def inventory_by_center(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("dc_name", "product_name").agg(F.sum("current_inventory").alias("current_inventory"))


def inventory_heatmap(inventory: DataFrame, dc_names: list[str]) -> DataFrame:
    """Products by the listed centers. The listed values spare the pass that finds them."""
    return (
        inventory.groupBy("product_name").pivot("dc_name", dc_names).agg(F.sum("current_inventory")).fillna(0)
    )


def top_skus(inventory: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` products with the most stock over all centers."""
    return (
        inventory.groupBy("product_name")
        .agg(F.sum("current_inventory").alias("current_inventory"))
        .orderBy(F.desc("current_inventory"), "product_name")
        .limit(n)
    )


def inventory_table(inventory: DataFrame) -> DataFrame:
    wanted = ["sku_id", "product_name", "dc_name", "current_inventory", "safety_stock_level"]
    ties = [c for c in ("sku_id", "dc_name") if c in inventory.columns]
    return available_columns(inventory, wanted).orderBy(F.desc("current_inventory"), *ties)


# Reference lines of the supplier matrix.
RELIABILITY_LINE_PCT = 90
LEAD_TIME_LINE_DAYS = 10


def supplier_scorecard(performance: DataFrame) -> DataFrame:
    """Reliability in percent, grade, and the side of both reference lines."""
    percent = F.col("reliability_score") * 100
    return performance.select(
        "supplier_id",
        F.coalesce("supplier_name", F.col("supplier_id").cast("string"), F.lit("Unknown")).alias("supplier_name"),
        "avg_lead_time_days",
        percent.alias("reliability_pct"),
        "performance_score",
        bands.supplier_grade(F.col("performance_score")).alias("grade"),
        (percent >= RELIABILITY_LINE_PCT).alias("meets_reliability"),
        (F.col("avg_lead_time_days") <= LEAD_TIME_LINE_DAYS).alias("meets_lead_time"),
    ).orderBy(F.desc("performance_score"), "supplier_id")


def stockout_alert_view(alerts: DataFrame) -> DataFrame:
    """The alert table with formatted numbers, most urgent first."""
    days: Column = F.col("days_to_stockout")
    return (
        normalize_stockout(alerts)
        .select(
            "sku_id",
            "dc_id",
            F.col("product_name").alias("product"),
            F.col("dc_name").alias("distribution_center"),
            thousands(F.col("stock_level")).alias("current_stock"),
            thousands(F.col("safety_stock_level")).alias("safety_stock"),
            compact_number(F.col("demand_rate_per_day")).alias("demand_per_day"),
            fixed(days, 2).alias("days_left"),
            bands.alert_band(days).alias("severity"),
            days,
        )
        .orderBy(days, "sku_id", "dc_id")
        .drop("days_to_stockout")
    )


def alert_counts(alerts: DataFrame) -> DataFrame:
    severity = F.col("severity")
    return normalize_stockout(alerts).agg(
        F.count("*").alias("total_alerts"),
        F.count_if(severity == "critical").alias("critical"),
        F.count_if(severity == "high").alias("high"),
        F.count_if(severity == "medium").alias("warning"),
    )
