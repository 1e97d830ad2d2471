"""Inventory accounting: receiving, fulfilment, balances, reorder and policy."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quaymaster.functions.scalars import instant, moment, plus_days, ratio, stable_id
from quaymaster.operators.running import floored_total

PAIR = ["sku_id", "dc_id"]

# Accounting parameters.
MINIMUM_BASE_STOCK = 100
SAFETY_DAYS = 7
REORDER_COVERAGE_DAYS = 21
MINIMUM_REORDER = 50


# State ---------------------------------------------------------------------


def apply_deltas(state: DataFrame, deltas: DataFrame, as_of: datetime) -> DataFrame:
    """New version of the state with ``delta`` units added per pair.

    Pairs that the state does not know are ignored. Both sides have one row per
    pair, so the join is balanced.
    """
    touched = F.col("delta").isNotNull()
    stamp = F.when(touched, instant(state, "last_updated", as_of)).otherwise(F.col("last_updated"))
    return (
        state.join(deltas.select(*PAIR, "delta"), PAIR, "left")
        .withColumn("on_hand_qty", (F.col("on_hand_qty") + F.coalesce("delta", F.lit(0))).cast("bigint"))
        .withColumn("last_updated", stamp)
        .select(*state.columns)
    )


def snapshot(state: DataFrame, as_of: datetime) -> DataFrame:
    """One inventory event per state row."""
    return state.select(
        stable_id(F.col("sku_id"), F.col("dc_id"), F.lit(as_of.isoformat())).alias("inventory_event_id"),
        *PAIR,
        "on_hand_qty",
        "safety_stock",
        "reorder_point",
        moment(as_of).alias("inventory_ts"),
    )


# Receiving --------------------------------------------------------------------


def due_shipments(shipments: DataFrame, as_of: datetime, limit: int | None = None) -> DataFrame:
    """Open shipments whose expected arrival has come; a batch takes the earliest first."""
    due = shipments.where(
        F.col("actual_arrival_ts").isNull()
        & (F.col("expected_arrival_ts") <= instant(shipments, "expected_arrival_ts", as_of))
    )
    return due if limit is None else due.orderBy("expected_arrival_ts", "shipment_id").limit(limit)


def received_units(due: DataFrame) -> DataFrame:
    return due.groupBy("sku_id", F.col("destination_dc_id").alias("dc_id")).agg(F.sum("quantity").alias("delta"))


def mark_received(due: DataFrame, as_of: datetime) -> DataFrame:
    return due.withColumn("actual_arrival_ts", instant(due, "expected_arrival_ts", as_of))


def receive_shipments(
    shipments: DataFrame, state: DataFrame, as_of: datetime, limit: int | None = None
) -> DataFrame:
    """State after all due shipments have been added to the stock on hand."""
    return apply_deltas(state, received_units(due_shipments(shipments, as_of, limit)), as_of)


# Fulfilment -----------------------------------------------------------------------


def ledger(state: DataFrame, orders: DataFrame, received: DataFrame | None = None) -> DataFrame:
    """Every movement of a pair in order, with the stock before and after it.

    Step 0 is the opening stock (none if below zero), 1 a receipt, 2 an order, which takes what is there and no more
    than it asks for. At equal times a receipt precedes an order. ``(order_ts, order_id)`` has to be unique within a pair.
    Opening stock and receipts enter as movements like the orders, so no join with the state is needed, and
    one sorted pass gives stock, fulfilment and balances. ``units`` is what moved; ``requested_qty`` and ``order_id`` are null
    but for orders.
    """
    id_type, ts_type = orders.schema["order_id"].dataType, orders.schema["order_ts"].dataType
    nothing, quantity = F.lit(None).cast("bigint"), lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(0))

    def rows(frame, dc, ts, step, order_id, movement_id, asked, units):
        return frame.select(
            "sku_id", F.col(dc).alias("dc_id"), ts.cast(ts_type).alias("moved_ts"), F.lit(step).alias("step"),
            order_id.cast(id_type).alias("order_id"), movement_id.cast("string").alias("movement_id"),
            asked.cast("bigint").alias("requested_qty"), units.alias("_units"))

    moves = rows(state, "dc_id", F.lit(None), 0, F.lit(None), F.lit(""), nothing, F.greatest(F.lit(0), quantity("on_hand_qty")))
    moves = moves.unionByName(
        rows(orders, "dc_id", F.col("order_ts"), 2, F.col("order_id"), F.col("order_id"), F.col("requested_qty"), -quantity("requested_qty")))
    if received is not None:
        moves = moves.unionByName(rows(
            received, "destination_dc_id", F.col("actual_arrival_ts"), 1, F.lit(None), F.col("shipment_id"), nothing, quantity("quantity")))
    order = ["moved_ts", "step", "order_id", "movement_id"]
    return floored_total(moves, PAIR, order, "_units", "balance_before", "balance_after").withColumn(
        "units", F.col("balance_after") - F.col("balance_before")).drop("_units")


def fulfilled_orders(moves: DataFrame) -> DataFrame:
    """The orders of a ledger with what they got and what was lost."""
    asked, got = F.coalesce("requested_qty", F.lit(0)), -F.col("units")
    return moves.where(F.col("step") == 2).select(
        "order_id", *PAIR, "requested_qty", F.col("moved_ts").alias("order_ts"), got.alias("fulfilled_qty"),
        (asked - got).alias("lost_sales_qty"), (asked > got).alias("lost_sale_flag"))


def fulfil_orders(orders: DataFrame, state: DataFrame, received: DataFrame | None = None) -> DataFrame:
    """Serve orders in order of arrival from the opening stock of their pair and the shipments received before them."""
    return fulfilled_orders(ledger(state, orders, received))


def state_after_orders(state: DataFrame, orders: DataFrame, as_of: datetime) -> DataFrame:
    """Stock left per pair. Needs only the requested total: served in order, stock ends at
    what the total leaves, never below zero."""
    asked = orders.groupBy(*PAIR).agg((-F.sum("requested_qty")).alias("delta"))
    return apply_deltas(state, asked, as_of).withColumn("on_hand_qty", F.greatest(F.lit(0), F.col("on_hand_qty")))


# Balance -----------------------------------------------------------------------------


def inventory_balance(moves: DataFrame) -> DataFrame:
    """Stock before and after every movement of a ledger."""
    return moves.select(*PAIR, "moved_ts", "step", "movement_id", "units", "balance_before", "balance_after")


def closing_balance(moves: DataFrame) -> DataFrame:
    """Stock of every pair after all movements of a ledger: what has moved in all, as a ledger starts at zero."""
    return moves.groupBy(*PAIR).agg(F.sum("units").alias("closing_qty"))


# Reorder and policy ------------------------------------------------------------------------


def reorder_quantity(daily_demand: Column, spread: float = 1.0) -> Column:
    units = (daily_demand * F.lit(REORDER_COVERAGE_DAYS) * F.lit(float(spread))).cast("bigint")
    return F.greatest(units, F.lit(MINIMUM_REORDER))


def reorder_candidates(state: DataFrame, skus: DataFrame, limit: int | None = None) -> DataFrame:
    """Pairs at or below their reorder point with the quantity to order; unknown SKUs are left out."""
    low = state.where(F.col("on_hand_qty") <= F.col("reorder_point"))
    if limit is not None:
        low = low.orderBy(*PAIR).limit(limit)
    return low.join(skus.select("sku_id", "demand_base_lambda"), "sku_id").select(
        *PAIR, "on_hand_qty", "reorder_point", reorder_quantity(F.col("demand_base_lambda")).alias("reorder_qty")
    )


def stock_policy(assortment: DataFrame, skus: DataFrame, multiplier: float = 1.0) -> DataFrame:
    """Base stock, safety stock and reorder point of every stocked pair."""
    demand = F.col("demand_base_lambda")
    base = (demand * F.col("stock_coverage_days") * F.lit(float(multiplier))).cast("bigint")
    safety = (demand * SAFETY_DAYS).cast("bigint")
    return assortment.select(*PAIR).join(skus, "sku_id").select(
        *PAIR,
        F.greatest(base, F.lit(MINIMUM_BASE_STOCK)).alias("base_stock"),
        safety.alias("safety_stock"),
        ((demand * F.col("lead_time_days")).cast("bigint") + safety).alias("reorder_point"),
        "stock_coverage_days",
    )


def known_pairs(*facts: DataFrame) -> DataFrame:
    """Every pair that one of the facts has, once; facts are reduced to pairs before they are united."""
    return reduce(DataFrame.unionByName, [f.select(*PAIR).distinct() for f in facts]).distinct()


def initial_state(policy: DataFrame, as_of: datetime) -> DataFrame:
    """State before the first order: every pair holds its base stock."""
    return policy.select(
        *PAIR, F.col("base_stock").alias("on_hand_qty"), "safety_stock", "reorder_point", "base_stock",
        "stock_coverage_days", moment(as_of).alias("last_updated"),
    )


def supplier_weights(suppliers: DataFrame) -> DataFrame:
    """Share of each supplier in the squared reliability of all."""
    squared = F.col("reliability_score") * F.col("reliability_score")
    total = suppliers.agg(F.sum(squared)).scalar()
    return suppliers.select("supplier_id", "reliability_score", ratio(squared, total).alias("weight"))


def sku_event_share(skus: DataFrame) -> DataFrame:
    """Demand share of each SKU."""
    total = skus.agg(F.sum("demand_base_lambda")).scalar()
    return skus.select("sku_id", ratio(F.col("demand_base_lambda"), total).alias("demand_share"))


def expected_arrival(ts: Column, lead_days: Column) -> Column:
    """Arrival after the lead time."""
    return plus_days(ts, lead_days)
