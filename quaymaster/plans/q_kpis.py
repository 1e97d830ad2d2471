"""KPI queries."""

from __future__ import annotations

import hashlib

from quaymaster import schemas
from quaymaster.operators import kpis, setops
from quaymaster.plans.kpi_run import Dimensions, Facts, compute_kpis, dashboard
from quaymaster.plans.registry import (
    DAYS, MINUTES, ORDERS_AS_OF, RECENT_INVENTORY, RECENT_ORDERS, RECENT_SHIPMENTS, query, rounded,
)
from quaymaster.plans.sql import with_views
from quaymaster.sources.retail_views import RetailViews
from quaymaster.session import folder_exists, move_folder, run_root, scratch_path
from quaymaster.sinks.archive import ArchiveTable, append_new, read_archive
from quaymaster.sinks.sketches import read_sketches
from quaymaster.sources.tables import Period, recent
from pyspark.sql import functions as F


def window_orders(v: RetailViews):
    return recent(v.orders_fact(), "order_ts", Period(v.orders_as_of, MINUTES))


def window_inventory(v: RetailViews):
    return recent(v.inventory_fact(), "inventory_ts", Period(v.inventory_as_of, MINUTES))


def window_stock(v: RetailViews):
    """The stock roll-up of the window, built before any dimension is joined."""
    return v.stock_rollup(Period(v.inventory_as_of, MINUTES).start)


def window_shipments(v: RetailViews):
    return recent(v.shipments_fact(), "shipment_ts", Period(v.orders_as_of, MINUTES))


WO = f"SELECT * FROM orders_fact WHERE {RECENT_ORDERS}"
WI = f"SELECT * FROM inventory_fact WHERE {RECENT_INVENTORY}"
WS = f"SELECT * FROM shipments_fact WHERE {RECENT_SHIPMENTS}"

# Inventory level ------------------------------------------------------------

LEVEL = """SELECT a.sku_id, product_name, category, a.dc_id, dc_name,
 trunc(stock)::INT AS current_inventory, trunc(safety)::INT AS safety_stock_level
FROM (SELECT sku_id, dc_id, {stock} AS stock, avg(safety_stock) AS safety FROM {source} GROUP BY ALL) a
LEFT JOIN skus USING (sku_id) LEFT JOIN dcs USING (dc_id)"""
AVG_STOCK = "avg(on_hand_qty)"
LATEST_STOCK = "arg_max(on_hand_qty, {'t': inventory_ts, 'q': on_hand_qty})"


@query("kpi_inventory_level", "F1 A2 A4 C1 C6 D1 D2 E1 G2 H5",
       with_views("inventory_fact skus dcs", LEVEL.format(stock=AVG_STOCK, source="wi"), wi=WI))
def inventory_level(v):
    return kpis.inventory_level_from(window_stock(v), v.skus(), v.dcs())


@query("kpi_inventory_level_latest", "F1 A7",
       with_views("inventory_fact skus dcs", LEVEL.format(stock=LATEST_STOCK, source="wi"), wi=WI))
def inventory_level_latest(v):
    return kpis.inventory_level_from(window_stock(v), v.skus(), v.dcs(), stock="latest_on_hand")


# Demand and stockout ------------------------------------------------------------

VELOCITY = """SELECT sku_id, dc_id, sum({units})::BIGINT AS total_ordered, count(*) AS order_count,
 round(CASE WHEN sum({units}) > 0 THEN sum({units})::DOUBLE / ({minutes} / 1440.0) ELSE 0 END, 6) AS units_per_day
FROM {source} GROUP BY ALL"""


@query("kpi_demand_velocity", "F2a E2 C2 C5 H3",
       with_views("orders_fact", VELOCITY.format(units="quantity", minutes=MINUTES, source="wo"), wo=WO))
def demand_velocity(v):
    return rounded(kpis.demand_velocity(window_orders(v), float(DAYS)), 6, "units_per_day")


@query("kpi_demand_velocity_fulfilled", "F2a",
       with_views("orders_fact", VELOCITY.format(units="fulfilled_qty", minutes=MINUTES, source="wo"), wo=WO))
def demand_velocity_fulfilled(v):
    return rounded(kpis.demand_velocity(window_orders(v), float(DAYS), "fulfilled_qty"), 6, "units_per_day")


COVER = """SELECT s.sku_id, s.dc_id, current_stock, safety_stock, coalesce(units_per_day, 0) AS units_per_day,
 CASE WHEN current_stock IS NULL OR current_stock <= 0 THEN 0.0
  WHEN coalesce(units_per_day, 0) <= 0 THEN 9999.0
  WHEN current_stock - safety_stock <= 0 THEN 0.0
  ELSE (current_stock - safety_stock) / units_per_day END::DOUBLE AS days
FROM (SELECT sku_id, dc_id, {stock}::DOUBLE AS current_stock, max(safety_stock) AS safety_stock FROM {inv} GROUP BY ALL) s
LEFT JOIN (SELECT sku_id, dc_id, CASE WHEN sum(quantity) > 0 THEN sum(quantity)::DOUBLE / {days} ELSE 0 END AS units_per_day
 FROM {ord} GROUP BY ALL) d ON s.sku_id = d.sku_id AND s.dc_id = d.dc_id"""
RISK = """SELECT c.sku_id, product_name, category, c.dc_id, dc_name, region_name,
 round(current_stock, 6) AS stock_level, safety_stock::DOUBLE AS safety_stock_level,
 round(units_per_day, 6) AS demand_rate_per_day, round(days, 6) AS days_until_stockout,
 CASE WHEN days <= 3 THEN 'Critical' WHEN days <= 7 THEN 'Warning' ELSE 'Normal' END AS severity
FROM cover c LEFT JOIN skus USING (sku_id) LEFT JOIN dcs USING (dc_id) LEFT JOIN regions USING (region_id)
WHERE days < 7"""
DIMS = "skus dcs regions"
RISK_DOUBLES = ("stock_level", "demand_rate_per_day", "days_until_stockout")


def cover_of(stock=AVG_STOCK, inv="wi", ord="wo", days=float(DAYS)):
    return COVER.format(stock=stock, inv=inv, ord=ord, days=days)


def risk_of(v: RetailViews, stock, orders, days: float, level: str = "avg_on_hand"):
    cover = kpis.days_of_cover(stock, kpis.demand_rollup(orders), days, level)
    return kpis.stockout_risk_from(cover, v.skus(), v.dcs(), v.regions())


@query("kpi_stockout_risk", "F2b D3 D4 E3 C3 C4 C5 H4",
       with_views(f"inventory_fact orders_fact {DIMS}", RISK, wi=WI, wo=WO, cover=cover_of()))
def stockout_risk(v):
    return rounded(risk_of(v, window_stock(v), window_orders(v), float(DAYS)), 6, *RISK_DOUBLES)


@query("kpi_stockout_risk_latest", "F2b",
       with_views(f"inventory_fact orders_fact {DIMS}", RISK, wi=WI, wo=WO, cover=cover_of(LATEST_STOCK)))
def stockout_risk_latest(v):
    return rounded(risk_of(v, window_stock(v), window_orders(v), float(DAYS), "latest_on_hand"), 6, *RISK_DOUBLES)


# Suppliers -------------------------------------------------------------------------

PERFORMANCE = """SELECT supplier_id, supplier_name, round(reliability_score, 6) AS reliability_score, n AS shipment_count,
 round(m, 6) AS avg_lead_time_days, round(s, 6) AS lead_time_std_dev,
 round(CASE WHEN s IS NULL THEN 1.0 ELSE 1.0 - s / nullif(m, 0) END, 6) AS performance_score
FROM (SELECT supplier_id, count(*) AS n, avg(lead_time_days) AS m, stddev_samp(lead_time_days) AS s FROM {source} GROUP BY ALL) a
LEFT JOIN suppliers USING (supplier_id)"""
SCORES = ("reliability_score", "avg_lead_time_days", "lead_time_std_dev", "performance_score")


@query("kpi_supplier_performance", "F3 D5 E4 H3",
       with_views("shipments_fact suppliers", PERFORMANCE.format(source="ws"), ws=WS))
def supplier_performance(v):
    return rounded(kpis.supplier_performance(window_shipments(v), v.suppliers()), 6, *SCORES)


@query("lead_time_vs_plan", "F14 E4 D5", with_views("shipments_fact suppliers", """
SELECT supplier_id, supplier_name, n AS shipment_count, round(m, 6) AS avg_lead_time_days,
 round(avg_lead_time_days, 6) AS planned_lead_time_days, round(m - avg_lead_time_days, 6) AS lead_time_gap_days,
 round((m - avg_lead_time_days) / nullif(avg_lead_time_days, 0), 6) AS lead_time_gap_share
FROM (SELECT supplier_id, count(*) AS n, avg(lead_time_days) AS m FROM shipments_fact GROUP BY ALL) a
LEFT JOIN suppliers USING (supplier_id)"""))
def lead_time_vs_plan(v):
    out = kpis.lead_time_vs_plan(v.shipments_fact(), v.suppliers())
    return rounded(out, 6, "avg_lead_time_days", "planned_lead_time_days", "lead_time_gap_days", "lead_time_gap_share")


# Distribution centers -----------------------------------------------------------------

USAGE = """SELECT dc_id, dc_name, capacity_m3, vol AS occupied_volume_m3, vol / nullif(capacity_m3, 0) AS utilization_rate,
 CASE WHEN vol / nullif(capacity_m3, 0) >= 0.85 THEN 'OVERLOADED' WHEN vol / nullif(capacity_m3, 0) >= 0.70 THEN 'HIGH'
  WHEN vol / nullif(capacity_m3, 0) >= 0.50 THEN 'NORMAL' ELSE 'LOW' END AS status
FROM (SELECT dc_id, sum(on_hand_qty * storage_m3) AS vol FROM {source} LEFT JOIN skus USING (sku_id) GROUP BY ALL) a
LEFT JOIN dcs USING (dc_id)"""
SHOW_USAGE = """SELECT dc_id, dc_name, capacity_m3, round(occupied_volume_m3, 6) AS occupied_volume_m3,
 round(utilization_rate, 9) AS utilization_rate, status FROM usage"""
NEWEST = """SELECT sku_id, dc_id, arg_max(on_hand_qty, {'t': inventory_ts, 'q': on_hand_qty}) AS on_hand_qty
FROM wi GROUP BY ALL"""


def shown(usage):
    """Volumes have three decimals; rates need nine to be free of ties."""
    return rounded(rounded(usage, 6, "occupied_volume_m3"), 9, "utilization_rate")


@query("kpi_dc_utilization", "F4 D6 E5 D2 C5",
       with_views("inventory_fact skus dcs", SHOW_USAGE, wi=WI, usage=USAGE.format(source="wi")))
def dc_utilization(v):
    return shown(kpis.dc_utilization_from(window_stock(v), v.skus(), v.dcs()))


@query("kpi_dc_utilization_latest", "F4",
       with_views("inventory_fact skus dcs", SHOW_USAGE, wi=WI, newest=NEWEST, usage=USAGE.format(source="newest")))
def dc_utilization_latest(v):
    return shown(kpis.dc_utilization_from(window_stock(v), v.skus(), v.dcs(), mode="latest"))


@query("overloaded_dc_count", "E9 C3", with_views(
    "inventory_fact skus dcs", "SELECT count(*) FILTER (utilization_rate >= 0.85) AS overloaded_dcs FROM usage",
    wi=WI, usage=USAGE.format(source="wi")))
def overloaded_dc_count(v):
    return kpis.overloaded_count(kpis.dc_utilization_from(window_stock(v), v.skus(), v.dcs()))


@query("capacity_alerts", "F17", with_views(
    "inventory_fact skus dcs", """SELECT dc_id, dc_name, round(utilization_rate, 9) AS utilization_rate,
 CASE WHEN utilization_rate > 0.90 THEN 'CRITICAL' WHEN utilization_rate > 0.75 THEN 'ABOVE_TARGET' ELSE 'OK' END AS capacity_alert
FROM usage""", wi=WI, usage=USAGE.format(source="wi")))
def capacity_alerts(v):
    usage = kpis.dc_utilization_from(window_stock(v), v.skus(), v.dcs())
    return rounded(kpis.capacity_alerts(usage), 9, "utilization_rate")


# Regions and revenue -----------------------------------------------------------------------

REGIONAL = """SELECT region_id, region_name, count(*) AS total_orders, sum(quantity)::BIGINT AS total_units_fulfilled,
 sum(order_value)::DOUBLE AS revenue, round(sum(order_value)::DOUBLE / count(order_value), 6) AS avg_order_value,
 round(sum(order_value)::DOUBLE / count(*), 6) AS revenue_per_order
FROM {source} LEFT JOIN dcs USING (dc_id) LEFT JOIN regions USING (region_id) GROUP BY region_id, region_name"""


@query("kpi_regional_performance", "F5 D7 E6 A2",
       with_views("orders_fact dcs regions", REGIONAL.format(source="wo"), wo=WO))
def regional_performance(v):
    out = kpis.regional_performance(window_orders(v), v.dcs(), v.regions())
    return rounded(out, 6, "avg_order_value", "revenue_per_order")


@query("kpi_recent_revenue", "F6",
       with_views("orders_fact", "SELECT sum(order_value)::DOUBLE AS revenue, count(*) AS orders FROM wo", wo=WO))
def recent_revenue(v):
    return kpis.recent_revenue(window_orders(v))


@query("revenue_trend", "F15 A2", with_views("orders_fact", f"""
SELECT dc_id, count(*) FILTER (cur) AS current_orders, coalesce(sum(quantity) FILTER (cur), 0)::BIGINT AS current_units,
 coalesce(sum(order_value) FILTER (cur), 0)::DOUBLE AS current_revenue,
 count(*) FILTER (NOT cur) AS previous_orders, coalesce(sum(quantity) FILTER (NOT cur), 0)::BIGINT AS previous_units,
 coalesce(sum(order_value) FILTER (NOT cur), 0)::DOUBLE AS previous_revenue,
 round((coalesce(sum(order_value) FILTER (cur), 0)::DOUBLE - coalesce(sum(order_value) FILTER (NOT cur), 0)::DOUBLE)
  / nullif(coalesce(sum(order_value) FILTER (NOT cur), 0)::DOUBLE, 0), 6) AS revenue_change
FROM (SELECT *, {RECENT_ORDERS} AS cur FROM orders_fact WHERE order_ts >= {ORDERS_AS_OF} - INTERVAL {2 * DAYS} DAY)
GROUP BY dc_id"""))
def revenue_trend(v):
    out = kpis.trend(v.orders_fact(), "order_ts", Period(v.orders_as_of, MINUTES), 2 * MINUTES, ["dc_id"])
    return rounded(out, 6, "revenue_change")


# Unified history: hot and cold tiers as one table -------------------------------------------


def history(v: RetailViews, name: str, facts, as_of):
    """A fact from both tiers: all but the window is archived, and the hot tier still holds a
    window's length of archived rows, as after a run whose delete did not happen."""
    ts, event_id, cutoff = schemas.FACT_TIME[name], HISTORY_ID[name], Period(as_of, MINUTES).start
    base = standing_archive(v, ArchiveTable(name, facts, ts, event_id), cutoff)
    hot = recent(facts, ts, Period(as_of, 2 * MINUTES))
    cold = read_archive(v.spark, f"{base}/{name}", facts.schema.fields)
    if cold is None:
        return hot
    return setops.unify(hot, cold, event_id, ts, cutoff, read_sketches(v.spark, f"{base}/{name}"))


def standing_archive(v: RetailViews, table: ArchiveTable, cutoff) -> str:
    """The archive of a fact, as a run before the query has left it: written where this application has none of these files yet.

    It goes by the name, size and time of the files that the fact is read from, so a changed table gets another
    one, and it is written aside and renamed, so what stands there is whole. ``archive_run`` measures the writing.
    """
    key = hashlib.md5(repr((v.file_versions(), table.name, cutoff)).encode()).hexdigest()
    base = f"{run_root(v.spark)}/archives/{key}"
    if not folder_exists(v.spark, base):
        aside = scratch_path(v.spark, f"archive-{table.name}")
        append_new(table, aside, cutoff)
        move_folder(v.spark, aside, base)
    return base


HISTORY_ID = {"orders_fact": "order_line_id", "inventory_fact": "inventory_event_id", "shipments_fact": "shipment_id"}


def history_orders(v: RetailViews):
    return history(v, "orders_fact", v.orders_fact(), v.orders_as_of)


def history_inventory(v: RetailViews):
    return history(v, "inventory_fact", v.inventory_fact(), v.inventory_as_of)


def history_shipments(v: RetailViews):
    return history(v, "shipments_fact", v.shipments_fact(), v.orders_as_of)


HISTORY_DAYS = "(SELECT date_diff('day', min(o_orderdate), max(o_orderdate)) FROM orders)"


def history_days(v: RetailViews) -> float:
    first = v.table("orders").agg(F.min("o_orderdate")).first()[0]
    return float((v.orders_as_of - first).days)


@query("unified_inventory_level", "F12 G1 F1",
       with_views("inventory_fact skus dcs", LEVEL.format(stock=AVG_STOCK, source="inventory_fact")))
def unified_inventory_level(v):
    return kpis.inventory_level(history_inventory(v), v.skus(), v.dcs())


@query("unified_stockout_risk", "F12 G1 F2b", with_views(
    f"inventory_fact orders_fact {DIMS}", RISK,
    cover=cover_of(inv="inventory_fact", ord="orders_fact", days=HISTORY_DAYS)))
def unified_stockout_risk(v):
    out = kpis.stockout_risk(
        history_inventory(v), history_orders(v), v.skus(), v.dcs(), v.regions(), history_days(v)
    )
    return rounded(out, 6, *RISK_DOUBLES)


@query("unified_supplier_performance", "F12 G1 F3",
       with_views("shipments_fact suppliers", PERFORMANCE.format(source="shipments_fact")))
def unified_supplier_performance(v):
    return rounded(kpis.supplier_performance(history_shipments(v), v.suppliers()), 6, *SCORES)


@query("unified_dc_utilization", "F12 G1 F4",
       with_views("inventory_fact skus dcs", SHOW_USAGE, usage=USAGE.format(source="inventory_fact")))
def unified_dc_utilization(v):
    return shown(kpis.dc_utilization(history_inventory(v), v.skus(), v.dcs()))


@query("unified_regional_performance", "F12 G1 F5",
       with_views("orders_fact dcs regions", REGIONAL.format(source="orders_fact")))
def unified_regional_performance(v):
    out = kpis.regional_performance(history_orders(v), v.dcs(), v.regions())
    return rounded(out, 6, "avg_order_value", "revenue_per_order")


# Lost sales ------------------------------------------------------------------------------------

LOST = """SELECT {keys}, sum(requested_qty)::BIGINT AS requested_units, sum(fulfilled_qty)::BIGINT AS fulfilled_units,
 sum(lost_sales_qty)::BIGINT AS lost_units, round(sum(lost_revenue)::DOUBLE, 2) AS lost_revenue,
 round(avg(lost_sale_flag::INT), 6) AS lost_order_rate
FROM {source} GROUP BY {keys}"""
LOST_ORDERS = "SELECT o.*, lost_sales_qty * unit_cost::DECIMAL(18,2) AS lost_revenue FROM orders_fact o LEFT JOIN skus USING (sku_id)"


def _lost(v, orders, *keys):
    return rounded(rounded(kpis.lost_sales(orders, list(keys), v.unit_costs()), 2, "lost_revenue"), 6, "lost_order_rate")


@query("lost_sales_by_sku", "F13",
       with_views("orders_fact skus", LOST.format(keys="sku_id", source="priced"), priced=LOST_ORDERS))
def lost_sales_by_sku(v):
    return _lost(v, v.orders_fact(), "sku_id")


@query("lost_sales_by_dc", "F13",
       with_views("orders_fact skus", LOST.format(keys="dc_id", source="priced"), priced=LOST_ORDERS))
def lost_sales_by_dc(v):
    return _lost(v, v.orders_fact(), "dc_id")


@query("lost_sales_by_region", "F13", with_views(
    "orders_fact skus dcs", LOST.format(keys="region_id", source="placed"), priced=LOST_ORDERS,
    placed="SELECT p.*, region_id FROM priced p LEFT JOIN dcs USING (dc_id)"))
def lost_sales_by_region(v):
    placed = v.orders_fact().join(v.dcs().select("dc_id", "region_id"), "dc_id", "left")
    return _lost(v, placed, "region_id")


@query("order_totals", "E14", with_views("orders_fact", """
SELECT count(*) AS orders_created, sum(requested_qty)::BIGINT AS total_requested,
 sum(fulfilled_qty)::BIGINT AS total_fulfilled, sum(lost_sales_qty)::BIGINT AS total_lost FROM orders_fact"""))
def order_totals(v):
    return kpis.order_totals(v.orders_fact())


# Rebalancing and coverage --------------------------------------------------------------------------

HISTORY_COVER = cover_of(inv="inventory_fact", ord="orders_fact", days=HISTORY_DAYS)


def _history_cover(v):
    return kpis.days_of_cover(v.stock_rollup(), kpis.demand_rollup(v.orders_fact()), history_days(v))


ENDS = """SELECT sku_id, dc_id, role, row_number() OVER (PARTITION BY sku_id, role ORDER BY abs(surplus) DESC, dc_id)::INT AS "rank",
 current_stock, units_per_day, abs(surplus) AS gap_units
FROM (SELECT *, count(*) FILTER (role = 'donor') OVER (PARTITION BY sku_id) AS dn,
 count(*) FILTER (role = 'receiver') OVER (PARTITION BY sku_id) AS rc FROM placed)
WHERE role IS NOT NULL AND dn > 0 AND rc > 0"""
PLACED = """SELECT *, CASE WHEN surplus > 0 AND haste < 0 THEN 'donor' WHEN surplus < 0 AND haste > 0 THEN 'receiver' END AS role
FROM (SELECT *, round(current_stock - avg(current_stock) OVER (PARTITION BY sku_id), 9) AS surplus,
 round(units_per_day - avg(units_per_day) OVER (PARTITION BY sku_id), 9) AS haste FROM cover)"""
SHOW_ENDS = """SELECT sku_id, dc_id, role, "rank", round(current_stock, 9) AS current_stock, round(units_per_day, 9) AS units_per_day, gap_units FROM ends"""
# Donors and receivers as intervals, joined where they overlap.
TRANSFERS = """SELECT d.sku_id, d.dc_id AS from_dc_id, r.dc_id AS to_dc_id, (least(d.hi, r.hi) - greatest(d.lo, r.lo))::BIGINT AS units
FROM sized d JOIN sized r ON d.sku_id = r.sku_id AND d.role = 'donor' AND r.role = 'receiver' AND d.lo < r.hi AND r.lo < d.hi"""
SIZED = """SELECT sku_id, dc_id, role, hi - gap AS lo, hi FROM (
 SELECT *, sum(gap) OVER (PARTITION BY sku_id, role ORDER BY "rank" ROWS UNBOUNDED PRECEDING) AS hi
 FROM (SELECT *, floor(gap_units)::BIGINT AS gap FROM ends) WHERE gap > 0)"""


def rebalance_ends(v):
    return kpis.inventory_rebalance(v.stock_rollup(), kpis.demand_rollup(v.orders_fact()), history_days(v))


@query("inventory_rebalance", "F16", with_views(
    "inventory_fact orders_fact", SHOW_ENDS, cover=HISTORY_COVER, placed=PLACED, ends=ENDS))
def inventory_rebalance(v):
    return rounded(rebalance_ends(v), 9, "current_stock", "units_per_day", "gap_units")


@query("transfer_plan", "F16", with_views(
    "inventory_fact orders_fact", TRANSFERS, cover=HISTORY_COVER, placed=PLACED, ends=ENDS, sized=SIZED))
def transfer_plan(v):
    """Which center gives how many units to which, for every SKU with both ends."""
    return kpis.transfer_plan(rebalance_ends(v))


POSITIONS = """SELECT region_id, region_name, revenue, stock_units,
 CASE WHEN revenue > avg(revenue) OVER () AND stock_units < avg(stock_units) OVER () THEN 'receiver'
  WHEN revenue < avg(revenue) OVER () AND stock_units > avg(stock_units) OVER () THEN 'donor' END AS role
FROM regional JOIN (SELECT region_id, sum(on_hand_qty)::BIGINT AS stock_units FROM inventory_state JOIN dcs USING (dc_id) GROUP BY region_id)
 USING (region_id)"""
REGIONAL_PLACED = """SELECT *, CASE WHEN surplus > 0 AND side = 'donor' THEN 'donor' WHEN surplus < 0 AND side = 'receiver' THEN 'receiver' END AS role
FROM (SELECT c.*, p.role AS side, round(current_stock - avg(current_stock) OVER (PARTITION BY sku_id), 9) AS surplus
 FROM cover c LEFT JOIN dcs USING (dc_id) LEFT JOIN positions p USING (region_id))"""
REGION_VIEWS = "inventory_fact inventory_state orders_fact dcs regions"
REGION_CTES = dict(regional=REGIONAL.format(source="orders_fact"), positions=POSITIONS)


def regional_revenue(v):
    return kpis.regional_performance_from(kpis.by_center(v.orders_fact()), v.dcs(), v.regions())


def regional_ends(v):
    return kpis.regional_rebalance(
        v.stock_rollup(), kpis.demand_rollup(v.orders_fact()), history_days(v), regional_revenue(v), v.dcs())


@query("regional_positions", "F16 F5", with_views(REGION_VIEWS, "SELECT * FROM positions", **REGION_CTES))
def regional_positions(v):
    """Regions of high demand and low stock, and the reverse."""
    return kpis.regional_positions(v.stock_rollup(), regional_revenue(v), v.dcs())


@query("regional_rebalance", "F16", with_views(
    REGION_VIEWS, SHOW_ENDS, **REGION_CTES, cover=HISTORY_COVER, placed=REGIONAL_PLACED, ends=ENDS))
def regional_rebalance(v):
    return rounded(regional_ends(v), 9, "current_stock", "units_per_day", "gap_units")


@query("regional_transfers", "F16", with_views(
    REGION_VIEWS, TRANSFERS, **REGION_CTES, cover=HISTORY_COVER, placed=REGIONAL_PLACED, ends=ENDS, sized=SIZED))
def regional_transfers(v):
    return kpis.transfer_plan(regional_ends(v))


@query("overloaded_transfers", "F16 F4", with_views("inventory_fact skus dcs", """
SELECT sku_id, dc_id, product_name, dc_name, round(utilization_rate, 9) AS utilization_rate,
 round(units * storage_m3, 6) AS volume_m3
FROM (SELECT sku_id, dc_id, sum(on_hand_qty) AS units FROM wi GROUP BY ALL) a LEFT JOIN skus USING (sku_id)
JOIN (SELECT dc_id, dc_name, utilization_rate FROM usage
 WHERE status = 'OVERLOADED' AND (SELECT count(*) FROM usage WHERE status = 'LOW') > 0) u USING (dc_id)""",
    wi=WI, usage=USAGE.format(source="wi")))
def overloaded_transfers(v):
    out = kpis.overloaded_transfers(window_stock(v), v.skus(), v.dcs())
    return rounded(rounded(out, 6, "volume_m3"), 9, "utilization_rate")


@query("coverage_alerts", "F17 F2b", with_views("inventory_fact orders_fact", """
SELECT sku_id, dc_id, round(current_stock, 6) AS current_stock, round(units_per_day, 6) AS units_per_day,
 round(days, 6) AS days_to_stockout,
 CASE WHEN days < 2 THEN 'UNDERSTOCK' WHEN days > 90 THEN 'OVERSTOCK' ELSE 'OK' END AS coverage FROM cover""",
    cover=HISTORY_COVER))
def coverage_alerts(v):
    return rounded(kpis.coverage_alerts(_history_cover(v)), 6, "current_stock", "units_per_day", "days_to_stockout")


# The whole job ----------------------------------------------------------------------------------------


def dimensions(v: RetailViews) -> Dimensions:
    return Dimensions(v.skus(), v.dcs(), v.regions(), v.suppliers())


def kpi_set(v: RetailViews, keep: bool = False):
    facts = Facts(window_orders(v), None, window_shipments(v))
    return compute_kpis(facts, dimensions(v), float(DAYS), keep, stock=window_stock(v))


TOTALS = """SELECT
 (SELECT coalesce(sum(trunc(m)), 0)::BIGINT FROM (SELECT avg(on_hand_qty) AS m FROM wi GROUP BY sku_id, dc_id)) AS total_inventory,
 (SELECT count(*) FROM cover WHERE days < 7) AS stockout_count,
 (SELECT coalesce(avg(m), 0) FROM (SELECT avg(lead_time_days) AS m FROM ws GROUP BY supplier_id)) AS avg_lead_time_days,
 (SELECT coalesce(avg(utilization_rate) * 100, 0) FROM usage) AS avg_utilization_pct,
 (SELECT coalesce(sum(order_value), 0)::DOUBLE FROM wo) AS total_revenue"""
TOTALS_VIEWS = dict(wi=WI, wo=WO, ws=WS, cover=cover_of(), usage=USAGE.format(source="wi"))


@query("executive_totals", "E10 F7", with_views(
    "inventory_fact orders_fact shipments_fact skus dcs", """SELECT total_inventory, stockout_count,
 round(avg_lead_time_days, 6) AS avg_lead_time_days, round(avg_utilization_pct, 6) AS avg_utilization_pct, total_revenue
FROM totals""", **TOTALS_VIEWS, totals=TOTALS))
def executive_totals(v):
    return rounded(dashboard(kpi_set(v)), 6, "avg_lead_time_days", "avg_utilization_pct")
