"""Queries behind the dashboard pages and the normalisation of KPI frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaymaster.functions import bands
from quaymaster.operators import kpis, views
from quaymaster.plans.q_kpis import (
    AVG_STOCK, DIMS, LEVEL, PERFORMANCE, REGIONAL, RISK, RISK_DOUBLES, TOTALS, TOTALS_VIEWS, USAGE, WI, WO, WS,
    cover_of, kpi_set, risk_of, window_orders, window_shipments, window_stock,
)
from quaymaster.plans.registry import DAYS, query, rounded
from quaymaster.plans.sql import with_views
from quaymaster.sources.retail_views import RetailViews

LEVELS = LEVEL.format(stock=AVG_STOCK, source="inventory_fact")
SCORED = PERFORMANCE.format(source="shipments_fact")
REGIONS = REGIONAL.format(source="orders_fact")


def level_all(v: RetailViews):
    return kpis.inventory_level_from(v.stock_rollup(), v.skus(), v.dcs())


def regional_all(v: RetailViews):
    return kpis.regional_performance_from(kpis.by_center(v.orders_fact()), v.dcs(), v.regions())


def usage_recent(v: RetailViews):
    return kpis.dc_utilization_from(window_stock(v), v.skus(), v.dcs())


def risk_recent(v: RetailViews):
    return risk_of(v, window_stock(v), window_orders(v), float(DAYS))


# Cards ---------------------------------------------------------------------------

COLOUR = "CASE WHEN {x} > {d} THEN 'danger' WHEN {x} > {w} THEN 'warning' ELSE 'success' END"


@query("executive_cards", "F7 E10 H9", with_views(
    "inventory_fact orders_fact shipments_fact skus dcs", f"""
SELECT format('{{:,}}', total_inventory) AS total_inventory, stockout_count::VARCHAR AS stockout_alerts,
 {COLOUR.format(x='stockout_count', d=20, w=10)} AS stockout_colour,
 printf('%.1f', avg_lead_time_days) AS avg_lead_time, printf('%.1f', avg_utilization_pct) || '%' AS dc_utilization,
 {COLOUR.format(x='avg_utilization_pct', d=85, w=75)} AS utilization_colour,
 CASE WHEN total_revenue < 1000000 THEN '$' || printf('%.1f', total_revenue / 1000) || 'K'
  ELSE '$' || printf('%.2f', total_revenue / 1000000) || 'M' END AS revenue
FROM totals""", **TOTALS_VIEWS, totals=TOTALS))
def executive_cards(v):
    from quaymaster.plans.kpi_run import dashboard

    return views.executive_cards(dashboard(kpi_set(v)))


# Suppliers --------------------------------------------------------------------------


@query("supplier_scorecard", "F8 G5", with_views("shipments_fact suppliers", """
SELECT supplier_id, coalesce(supplier_name, supplier_id::VARCHAR, 'Unknown') AS supplier_name, avg_lead_time_days,
 round(reliability_score * 100, 6) AS reliability_pct, performance_score,
 CASE WHEN performance_score >= 0.9 THEN 'A' WHEN performance_score >= 0.8 THEN 'B' WHEN performance_score >= 0.7 THEN 'C' ELSE 'D' END AS grade,
 round(reliability_score * 100, 6) >= 90 AS meets_reliability, avg_lead_time_days <= 10 AS meets_lead_time
FROM scored""", scored=SCORED))
def supplier_scorecard(v):
    scored = rounded(
        kpis.supplier_performance(v.shipments_fact(), v.suppliers()), 6, "avg_lead_time_days", "performance_score"
    )
    out = rounded(views.supplier_scorecard(scored), 6, "reliability_pct")
    return out.withColumn("meets_reliability", F.col("reliability_pct") >= 90)


@query("normalized_suppliers", "C7 C8 C9", with_views("shipments_fact suppliers", """
SELECT supplier_id, avg_lead_time_days, reliability_score, 0.0::DOUBLE AS performance_score FROM scored""",
    scored=SCORED))
def normalized_suppliers(v):
    scored = rounded(
        kpis.supplier_performance(v.shipments_fact(), v.suppliers()), 6, "avg_lead_time_days", "reliability_score"
    )
    renamed = scored.select(
        "supplier_id", F.col("avg_lead_time_days").alias("lead_time"), F.col("reliability_score").alias("reliability")
    )
    return views.available_columns(
        views.normalize_suppliers(renamed),
        ["supplier_id", "avg_lead_time_days", "reliability_score", "performance_score"],
    )


# Centers -----------------------------------------------------------------------------


@query("dc_status_view", "F9 G5 H9", with_views("inventory_fact skus dcs", """
SELECT dc_id, dc_name, round(utilization_rate * 100, 9) AS utilization_pct,
 printf('%.1f', utilization_rate * 100) || '%' AS utilization_text,
 CASE WHEN utilization_rate * 100 > 85 THEN 'Critical' WHEN utilization_rate * 100 > 75 THEN 'High' ELSE 'Normal' END AS badge
FROM usage""", wi=WI, usage=USAGE.format(source="wi")))
def dc_status_view(v):
    return rounded(views.dc_status_view(usage_recent(v)), 9, "utilization_pct")


@query("utilization_as_ratio", "C11 C7 C8", with_views("inventory_fact skus dcs", """
SELECT dc_id, round(CASE WHEN (SELECT max(utilization_rate) FROM usage) > 1 THEN utilization_rate / 100
 ELSE utilization_rate END, 11) AS utilization_rate FROM usage""", wi=WI, usage=USAGE.format(source="wi")))
def utilization_as_ratio(v):
    renamed = usage_recent(v).select("dc_id", F.col("utilization_rate").alias("util_rate"))
    out = views.normalize_utilization(renamed, rescale=True).select("dc_id", "utilization_rate")
    return rounded(out, 11, "utilization_rate")


# Inventory -----------------------------------------------------------------------------


@query("inventory_by_center", "E18", with_views("inventory_fact skus dcs", """
SELECT dc_name, product_name, sum(current_inventory)::BIGINT AS current_inventory FROM levels GROUP BY ALL""",
    levels=LEVELS))
def inventory_by_center(v):
    return views.inventory_by_center(level_all(v))


# The centers of the benchmark tables by name, for the columns of the SQL; the query takes them from the dimension.
HEAT_COLUMNS = ", ".join(
    f"""coalesce(sum(current_inventory) FILTER (dc_name = '{name}'), 0)::BIGINT AS "{name}\"""" for name in (f"NATION_{i}" for i in range(25)))


@query("inventory_heatmap", "E13", with_views(
    "inventory_fact skus dcs", f"SELECT product_name, {HEAT_COLUMNS} FROM levels GROUP BY product_name", levels=LEVELS))
def inventory_heatmap(v):
    """One column for each center of the dimension, whose few rows name the columns."""
    centers = sorted(r["dc_name"] for r in v.dcs().select("dc_name").distinct().toLocalIterator())
    return views.inventory_heatmap(level_all(v), centers)


@query("top_skus", "F11 E11 G3", with_views("inventory_fact skus dcs", """
SELECT product_name, sum(current_inventory)::BIGINT AS current_inventory FROM levels GROUP BY ALL
ORDER BY 2 DESC, 1 LIMIT 10""", levels=LEVELS))
def top_skus(v):
    return views.top_skus(level_all(v))


@query("inventory_table", "C12 G5", with_views("inventory_fact skus dcs", """
SELECT sku_id, product_name, dc_name, current_inventory, safety_stock_level FROM levels""", levels=LEVELS))
def inventory_table(v):
    return views.inventory_table(level_all(v))


@query("normalized_inventory", "C7 C8 C9 C10", with_views("inventory_fact inventory_state skus", """
SELECT sku_id, dc_id, coalesce(product_name, sku_id::VARCHAR) AS product_name, dc_id::VARCHAR AS dc_name,
 on_hand_qty::DOUBLE AS current_inventory, safety_stock::DOUBLE AS safety_stock_level
FROM inventory_state LEFT JOIN skus USING (sku_id)"""))
def normalized_inventory(v):
    named = v.skus().select("sku_id", "product_name")
    state = v.inventory_state().select("sku_id", "dc_id", "on_hand_qty", "safety_stock").join(named, "sku_id", "left")
    out = views.fallback_name(views.fallback_name(state, "product_name", "sku_id"), "dc_name", "dc_id")
    return views.available_columns(
        views.normalize_inventory(out),
        ["sku_id", "dc_id", "product_name", "dc_name", "current_inventory", "safety_stock_level", "absent_column"],
    )


@query("coerced_numbers", "C8 C9", """
SELECT o_orderkey AS order_id, coalesce(TRY_CAST(o_orderpriority AS DOUBLE), 0) AS malformed,
 coalesce(TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE), 0) AS priority_number,
 coalesce(TRY_CAST(o_orderpriority AS DOUBLE), 999) AS days_to_stockout, 0.0::DOUBLE AS absent FROM orders""")
def coerced_numbers(v):
    from quaymaster.functions.scalars import to_number

    named = v.table("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("tte"),
        to_number(F.col("o_orderpriority")).alias("malformed"),
        to_number(F.substring("o_orderpriority", 1, 1)).alias("priority_number"),
    )
    out = views.resolve_fields(named, views.STOCKOUT_FIELDS, views.UNKNOWN_DAYS)
    return views.resolve_fields(out, {"absent": ["no_such_column"]}).drop("tte")


# Regions -----------------------------------------------------------------------------------


@query("revenue_share", "E17", with_views("orders_fact dcs regions", """
SELECT region_id, region_name, revenue, round(revenue / (SELECT sum(revenue) FROM regional), 6) AS revenue_share FROM regional""",
    regional=REGIONS))
def revenue_share(v):
    return rounded(views.revenue_share(regional_all(v)), 6, "revenue_share")


@query("regional_cards", "G5 H9", with_views("orders_fact dcs regions", """
SELECT coalesce(region_name, region_id::VARCHAR, 'Unknown') AS region, '$' || format('{:,.0f}', revenue) AS revenue,
 format('{:,}', total_orders) || ' orders' AS orders FROM regional""", regional=REGIONS))
def regional_cards(v):
    return views.regional_view(regional_all(v))


@query("normalized_regional", "C7 C8", with_views("orders_fact dcs regions", """
SELECT region_id, region_name, revenue AS total_revenue, total_orders::DOUBLE AS total_orders FROM regional""",
    regional=REGIONS))
def normalized_regional(v):
    out = views.normalize_regional(regional_all(v))
    return views.available_columns(out, ["region_id", "region_name", "total_revenue", "total_orders"])


# Stockout alerts ------------------------------------------------------------------------------

RISKS = dict(wi=WI, wo=WO, cover=cover_of(), risk=RISK)
RISK_VIEWS = f"inventory_fact orders_fact {DIMS}"
ALERT_COUNTS = """SELECT count(*) AS total_alerts, count(*) FILTER (days_until_stockout < 1) AS critical,
 count(*) FILTER (days_until_stockout >= 1 AND days_until_stockout < 3) AS high,
 count(*) FILTER (days_until_stockout >= 3 AND days_until_stockout < 7) AS warning FROM risk"""


@query("stockout_alert_view", "F10 C7 C8 C10 H9 G5", with_views(RISK_VIEWS, """
SELECT sku_id, dc_id, product_name AS product, dc_name AS distribution_center,
 format('{:,.0f}', stock_level) AS current_stock, format('{:,.0f}', safety_stock_level) AS safety_stock,
 CASE WHEN demand_rate_per_day >= 1000000 THEN printf('%.2f', demand_rate_per_day / 1000000) || 'M'
  WHEN demand_rate_per_day >= 1000 THEN printf('%.1f', demand_rate_per_day / 1000) || 'K'
  ELSE format('{:,.0f}', demand_rate_per_day) END AS demand_per_day,
 printf('%.2f', days_until_stockout) AS days_left,
 CASE WHEN days_until_stockout < 1 THEN 'CRITICAL' WHEN days_until_stockout < 3 THEN 'HIGH'
  WHEN days_until_stockout < 7 THEN 'WARNING' ELSE 'LOW' END AS severity FROM risk""", **RISKS))
def stockout_alert_view(v):
    return views.stockout_alert_view(rounded(risk_recent(v), 6, *RISK_DOUBLES))


@query("alert_counts", "E12", with_views(RISK_VIEWS, ALERT_COUNTS, **RISKS))
def alert_counts(v):
    return views.alert_counts(risk_recent(v))


@query("alert_severity_groups", "E12 F10", with_views(RISK_VIEWS, """
SELECT CASE WHEN days_until_stockout < 1 THEN 'critical' WHEN days_until_stockout < 3 THEN 'high'
 WHEN days_until_stockout < 7 THEN 'medium' ELSE 'low' END AS severity, region_name, count(*) AS alerts
FROM risk GROUP BY ALL""", **RISKS))
def alert_severity_groups(v):
    named = views.normalize_stockout(risk_recent(v))
    return named.groupBy("severity", "region_name").agg(F.count("*").alias("alerts"))


@query("top_stockouts", "G3 F2b", with_views(RISK_VIEWS, """
SELECT sku_id, dc_id, days_until_stockout, severity FROM risk ORDER BY days_until_stockout, sku_id, dc_id LIMIT 50""",
    **RISKS))
def top_stockouts(v):
    top = rounded(risk_recent(v), 6, "days_until_stockout").orderBy("days_until_stockout", "sku_id", "dc_id")
    return top.limit(50).select("sku_id", "dc_id", "days_until_stockout", "severity")


# Bands over rows ---------------------------------------------------------------------------------


@query("demand_hour_bands", "H12 H1", """
SELECT hour(ts)::INT AS event_hour, CASE WHEN hour(ts) BETWEEN 9 AND 17 THEN 1.5 WHEN hour(ts) BETWEEN 18 AND 22 THEN 1.2
 ELSE 0.7 END::DOUBLE AS demand_factor, count(*) AS events FROM events GROUP BY ALL""")
def demand_hour_bands(v):
    hour = F.hour("ts")
    return v.events().groupBy(hour.alias("event_hour")).agg(F.count("*").alias("events")).withColumn(
        "demand_factor", bands.hour_demand_factor(F.col("event_hour"))
    )


@query("order_value_bands", "H13", with_views("orders_fact", """
SELECT CASE WHEN order_value > 5000 THEN 'high' WHEN order_value > 1000 THEN 'medium' ELSE 'low' END AS value_band,
 priority_level, count(*) AS orders, sum(order_value)::DOUBLE AS revenue FROM orders_fact GROUP BY ALL"""))
def order_value_bands(v):
    band = bands.order_value_band(F.col("order_value")).alias("value_band")
    return v.orders_fact().groupBy(band, "priority_level").agg(
        F.count("*").alias("orders"), F.sum("order_value").cast("double").alias("revenue")
    )
