"""Inventory accounting queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from quaymaster.functions.scalars import moment
from quaymaster.operators import accounting, kpis
from quaymaster.plans.registry import DAYS, INVENTORY_AS_OF, ORDERS_AS_OF, query, rounded, sql_time, text_time
from quaymaster.plans.sql import with_views
from quaymaster.session import materialise, scratch_path
from quaymaster.sinks.warehouse import Warehouse
from quaymaster.sources.retail_views import RetailViews

# Shipments that arrive after this many days before the newest snapshot are still open,
# and a receiving run takes place half of that time later.
OPEN_DAYS = 2 * DAYS
RECEIVED_UNTIL = f"{INVENTORY_AS_OF} - INTERVAL {OPEN_DAYS} DAY"
RUN_AT = f"{INVENTORY_AS_OF} - INTERVAL {DAYS} DAY"


def open_shipments(v: RetailViews):
    return v.shipments_fact(v.inventory_as_of - timedelta(days=OPEN_DAYS))


def run_at(v: RetailViews):
    return v.inventory_as_of - timedelta(days=DAYS)


def order_requests(v: RetailViews):
    """Requested units per order and pair: the lines of an order are one request."""
    return v.orders_fact().groupBy("order_id", "sku_id", "dc_id", "order_ts").agg(F.sum("requested_qty").alias("requested_qty"))


OPEN = f"SELECT * REPLACE (CASE WHEN actual_arrival_ts <= {RECEIVED_UNTIL} THEN actual_arrival_ts END AS actual_arrival_ts) FROM shipments_fact"
DUE = f"SELECT * FROM open_shipments WHERE actual_arrival_ts IS NULL AND expected_arrival_ts <= {RUN_AT}"
REQUESTS = """SELECT order_id, sku_id, dc_id, order_ts, sum(requested_qty)::BIGINT AS requested_qty
FROM orders_fact GROUP BY ALL"""
# Opening stock, receipts and orders in one sequence whose level never falls below zero: with running sum and
# least running sum (at most 0), the level is their difference.
MOVES = """SELECT sku_id, dc_id, NULL::TIMESTAMP AS moved_ts, 0 AS step, NULL::BIGINT AS order_id, '' AS movement_id, NULL::BIGINT AS requested_qty,
 greatest(0, on_hand_qty)::BIGINT AS asked FROM inventory_state
UNION ALL SELECT sku_id, destination_dc_id, actual_arrival_ts, 1, NULL, shipment_id, NULL, quantity::BIGINT FROM open_shipments WHERE actual_arrival_ts IS NOT NULL
UNION ALL SELECT sku_id, dc_id, order_ts, 2, order_id, order_id::VARCHAR, requested_qty, -requested_qty FROM requests"""
IN_ORDER = "PARTITION BY sku_id, dc_id ORDER BY moved_ts NULLS FIRST, step, order_id NULLS FIRST, movement_id"
RUNS = f"SELECT *, sum(asked) OVER ({IN_ORDER} ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM moves"
LEVELS = f"SELECT *, run - least(0, min(run) OVER ({IN_ORDER} ROWS UNBOUNDED PRECEDING)) AS balance_after FROM runs"
BALANCES = f"""SELECT *, balance_after - balance_before AS units
FROM (SELECT *, lag(balance_after, 1, 0) OVER ({IN_ORDER}) AS balance_before FROM levels)"""
FULFILLED = """SELECT order_id, sku_id, dc_id, requested_qty, moved_ts AS order_ts, -units AS fulfilled_qty,
 requested_qty + units AS lost_sales_qty, requested_qty + units > 0 AS lost_sale_flag FROM balances WHERE step = 2"""
LEDGER = dict(requests=REQUESTS, open_shipments=OPEN, moves=MOVES, runs=RUNS, levels=LEVELS, balances=BALANCES, fulfilled=FULFILLED)
LEDGER_VIEWS = "orders_fact shipments_fact inventory_state"


def ledger(v: RetailViews):
    """Opening stock, received shipments and order requests of every pair in order."""
    received = open_shipments(v).where(F.col("actual_arrival_ts").isNotNull())
    return accounting.ledger(v.inventory_state(), order_requests(v), received)


# Receiving ---------------------------------------------------------------------


@query("open_due_shipments", "I1 C14", with_views("shipments_fact", f"""
SELECT shipment_id, sku_id, destination_dc_id, quantity, strftime({RUN_AT}, '%Y-%m-%d %H:%M:%S') AS actual_arrival_ts
FROM due""", open_shipments=OPEN, due=DUE))
def open_due_shipments(v):
    received = accounting.mark_received(accounting.due_shipments(open_shipments(v), run_at(v)), run_at(v))
    return received.select("shipment_id", "sku_id", "destination_dc_id", "quantity", text_time("actual_arrival_ts"))


@query("receive_batch", "G4 I1", with_views("shipments_fact", """
SELECT shipment_id, sku_id, quantity FROM due ORDER BY expected_arrival_ts, shipment_id LIMIT 1000""",
    open_shipments=OPEN, due=DUE))
def receive_batch(v):
    due = accounting.due_shipments(open_shipments(v), run_at(v), limit=1000)
    return due.select("shipment_id", "sku_id", "quantity")


@query("receive_shipments", "I1 B7 D10", with_views("shipments_fact inventory_state", f"""
SELECT s.sku_id, s.dc_id, (on_hand_qty + coalesce(units, 0))::BIGINT AS on_hand_qty,
 strftime(CASE WHEN units IS NULL THEN last_updated ELSE {RUN_AT} END, '%Y-%m-%d %H:%M:%S') AS last_updated
FROM inventory_state s LEFT JOIN (SELECT sku_id, destination_dc_id AS dc_id, sum(quantity) AS units FROM due GROUP BY ALL) d
 ON s.sku_id = d.sku_id AND s.dc_id = d.dc_id""", open_shipments=OPEN, due=DUE))
def receive_shipments(v):
    out = accounting.receive_shipments(open_shipments(v), v.inventory_state(), run_at(v))
    return out.select("sku_id", "dc_id", "on_hand_qty", text_time("last_updated"))


@query("receive_committed", "I1 B7", with_views("shipments_fact inventory_state", f"""
SELECT s.sku_id, s.dc_id, (on_hand_qty + coalesce(units, 0))::BIGINT AS on_hand_qty, (SELECT count(*) FROM due) AS received_now
FROM inventory_state s LEFT JOIN (SELECT sku_id, destination_dc_id AS dc_id, sum(quantity) AS units FROM due GROUP BY ALL) d
 ON s.sku_id = d.sku_id AND s.dc_id = d.dc_id""", open_shipments=OPEN, due=DUE))
def receive_committed(v):
    """Due shipments are received in one commit with their arrival times; a second run finds nothing to receive."""
    sent, state = open_shipments(v), v.inventory_state().withColumn("on_hand_qty", F.col("on_hand_qty").cast("bigint"))
    warehouse = Warehouse(v.spark, scratch_path(v.spark, "warehouse"), sent.schema, state.schema)
    warehouse.start(sent, state)
    for _ in range(2):
        warehouse.receive(run_at(v))
    arrived = warehouse.shipments().where(F.col("actual_arrival_ts") == moment(run_at(v), "timestamp_ntz")).agg(F.count("*")).scalar()
    return warehouse.state().select("sku_id", "dc_id", "on_hand_qty", arrived.alias("received_now"))


# Fulfilment ------------------------------------------------------------------------


@query("fulfil_orders", "I2 D9 D10", with_views(LEDGER_VIEWS, f"""
SELECT order_id, sku_id, dc_id, requested_qty, {sql_time('order_ts')}, fulfilled_qty, lost_sales_qty, lost_sale_flag
FROM fulfilled""", **LEDGER))
def fulfil_orders(v):
    return accounting.fulfilled_orders(ledger(v)).withColumn("order_ts", text_time("order_ts"))


@query("state_after_orders", "I2 B7", with_views("orders_fact inventory_state", f"""
SELECT s.sku_id, s.dc_id, greatest(0, on_hand_qty - coalesce(units, 0))::BIGINT AS on_hand_qty,
 strftime(CASE WHEN units IS NULL THEN last_updated ELSE {ORDERS_AS_OF} END, '%Y-%m-%d %H:%M:%S') AS last_updated
FROM inventory_state s LEFT JOIN (SELECT sku_id, dc_id, sum(requested_qty) AS units FROM orders_fact GROUP BY ALL) d
 ON s.sku_id = d.sku_id AND s.dc_id = d.dc_id"""))
def state_after_orders(v):
    out = accounting.state_after_orders(v.inventory_state(), v.orders_fact(), v.orders_as_of)
    return out.select("sku_id", "dc_id", "on_hand_qty", text_time("last_updated"))


@query("lost_sales_after_fulfilment", "F13 I2", with_views(LEDGER_VIEWS + " skus", """
SELECT dc_id, sum(requested_qty)::BIGINT AS requested_units, sum(fulfilled_qty)::BIGINT AS fulfilled_units,
 sum(lost_sales_qty)::BIGINT AS lost_units, round(sum(lost_sales_qty * unit_cost::DECIMAL(18,2))::DOUBLE, 2) AS lost_revenue,
 round(avg(lost_sale_flag::INT), 6) AS lost_order_rate
FROM fulfilled LEFT JOIN skus USING (sku_id) GROUP BY dc_id""", **LEDGER))
def lost_sales_after_fulfilment(v):
    lost = kpis.lost_sales(accounting.fulfilled_orders(ledger(v)), ["dc_id"], v.unit_costs())
    return rounded(rounded(lost, 2, "lost_revenue"), 6, "lost_order_rate")


# Balance -----------------------------------------------------------------------------


@query("inventory_balance", "I3", with_views(LEDGER_VIEWS, """
SELECT sku_id, dc_id, step, movement_id, units, balance_before, balance_after FROM balances""", **LEDGER))
def inventory_balance(v):
    return accounting.inventory_balance(ledger(v)).drop("moved_ts")


@query("closing_balance", "I3", with_views(LEDGER_VIEWS, """
SELECT sku_id, dc_id, sum(units)::BIGINT AS closing_qty FROM balances GROUP BY ALL""", **LEDGER))
def closing_balance(v):
    return accounting.closing_balance(ledger(v))


# Reorder and policy ----------------------------------------------------------------------


@query("low_stock_pairs", "C13", with_views("inventory_state", """
SELECT sku_id, dc_id, on_hand_qty, reorder_point FROM inventory_state WHERE on_hand_qty <= reorder_point"""))
def low_stock_pairs(v):
    return v.inventory_state().where(F.col("on_hand_qty") <= F.col("reorder_point")).select(
        "sku_id", "dc_id", "on_hand_qty", "reorder_point"
    )


CANDIDATES = """SELECT sku_id, dc_id, on_hand_qty, reorder_point, greatest(demand_base_lambda * 21, 50)::BIGINT AS reorder_qty
FROM ({low}) JOIN skus USING (sku_id)"""
LOW = "SELECT * FROM inventory_state WHERE on_hand_qty <= reorder_point"


@query("reorder_candidates", "I4 C13 D9 H11", with_views("inventory_state skus", CANDIDATES.format(low=LOW)))
def reorder_candidates(v):
    return accounting.reorder_candidates(v.inventory_state(), v.skus())


@query("reorder_batch", "I4 G4", with_views(
    "inventory_state skus", CANDIDATES.format(low=LOW + " ORDER BY sku_id, dc_id LIMIT 100")))
def reorder_batch(v):
    return accounting.reorder_candidates(v.inventory_state(), v.skus(), limit=100)


POLICY = """SELECT sku_id, dc_id, greatest(floor(demand_base_lambda * stock_coverage_days * {m}), 100)::BIGINT AS base_stock,
 (demand_base_lambda * 7)::BIGINT AS safety_stock,
 (demand_base_lambda * lead_time_days + demand_base_lambda * 7)::BIGINT AS reorder_point, stock_coverage_days
FROM {pairs} JOIN skus USING (sku_id)"""


@query("stock_policy", "I5 H11", with_views(
    "inventory_state skus", POLICY.format(m=2.0, pairs="(SELECT sku_id, dc_id FROM inventory_state)")))
def stock_policy(v):
    return accounting.stock_policy(v.inventory_state(), v.skus(), multiplier=2.0)


@query("stock_policy_full", "I5", with_views(
    "inventory_state orders_fact skus", POLICY.format(
        m=1.0, pairs="(SELECT sku_id, dc_id FROM inventory_state UNION SELECT sku_id, dc_id FROM orders_fact)")))
def stock_policy_full(v):
    """Every pair that is stocked or was ordered."""
    return accounting.stock_policy(accounting.known_pairs(v.inventory_state(), v.orders_fact()), v.skus())


@query("supplier_weights", "I6", with_views("suppliers", """
SELECT supplier_id, round(reliability_score, 6) AS reliability_score,
 round(reliability_score * reliability_score / sum(reliability_score * reliability_score) OVER (), 9) AS weight FROM suppliers"""))
def supplier_weights(v):
    return rounded(rounded(accounting.supplier_weights(v.suppliers()), 9, "weight"), 6, "reliability_score")


@query("sku_event_share", "I7 H11", with_views("skus", """
SELECT sku_id, round(share, 9) AS demand_share FROM (SELECT sku_id, demand_base_lambda::DOUBLE / sum(demand_base_lambda) OVER () AS share FROM skus)"""))
def sku_event_share(v):
    return rounded(accounting.sku_event_share(v.skus()), 9, "demand_share")


@query("state_snapshot", "I8 H8", with_views("inventory_state", f"""
SELECT sku_id, dc_id, on_hand_qty, safety_stock, reorder_point, strftime({ORDERS_AS_OF}, '%Y-%m-%d %H:%M:%S') AS inventory_ts
FROM inventory_state"""))
def state_snapshot(v):
    out = accounting.snapshot(v.inventory_state(), v.orders_as_of)
    return out.drop("inventory_event_id").withColumn("inventory_ts", text_time("inventory_ts"))


@query("expected_arrivals", "I9 H14", with_views("shipments_fact suppliers", f"""
SELECT shipment_id, strftime(shipment_ts + to_microseconds((avg_lead_time_days * 1.5 * 86400000000)::BIGINT), '%Y-%m-%d %H:%M:%S') AS expected
FROM shipments_fact JOIN suppliers USING (supplier_id)"""))
def expected_arrivals(v):
    planned = v.suppliers().select("supplier_id", F.col("avg_lead_time_days").alias("plan"))
    sent = F.col("shipment_ts")
    return v.shipments_fact().join(planned, "supplier_id").select(
        "shipment_id",
        F.date_format(accounting.expected_arrival(sent, F.col("plan") * 1.5), "yyyy-MM-dd HH:mm:ss").alias("expected"),
    )
