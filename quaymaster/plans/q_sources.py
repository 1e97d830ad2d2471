"""Scans, time filters, scalar functions and set operations."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from quaymaster import schemas
from quaymaster.functions import scalars
from quaymaster.operators import setops
from quaymaster.plans.registry import (
    DAYS, EVENTS_AS_OF, MINUTES, ORDERS_AS_OF, RECENT_INVENTORY, RECENT_ORDERS, RECENT_SHIPMENTS, query, rounded,
    sql_time, text_time,
)
from quaymaster.plans.sql import with_views
from quaymaster.sources.retail_views import LINE_KEYS, line_id
from quaymaster.session import scratch_path
from quaymaster.sources import tables
from quaymaster.sources.tables import Period, recent

EVENTS = schemas.BENCHMARK["events"]


@query("scan_with_schema", "A1", f"SELECT event_id, {sql_time('ts')}, user_id, event_type, value, props FROM events")
def scan_with_schema(v):
    df = tables.scan(v.spark, EVENTS, f"{v.folder}/events.parquet")
    return df.select("event_id", text_time("ts"), "user_id", "event_type", "value", "props")


@query("recent_orders", "A2 H2 C3", with_views("orders_fact", f"""
SELECT order_line_id, sku_id, dc_id, quantity, priority_level, {sql_time('order_ts')} FROM orders_fact WHERE {RECENT_ORDERS}"""))
def recent_orders(v):
    df = recent(v.orders_fact(), "order_ts", Period(v.orders_as_of, MINUTES))
    return df.select("order_line_id", "sku_id", "dc_id", "quantity", "priority_level", text_time("order_ts"))


@query("recent_shipments", "A2", with_views("shipments_fact", f"""
SELECT shipment_id, supplier_id, quantity, lead_time_days FROM shipments_fact WHERE {RECENT_SHIPMENTS}"""))
def recent_shipments(v):
    df = recent(v.shipments_fact(), "shipment_ts", Period(v.orders_as_of, MINUTES))
    return df.select("shipment_id", "supplier_id", "quantity", "lead_time_days")


@query("recent_inventory", "A2", with_views("inventory_fact", f"""
SELECT inventory_event_id, sku_id, dc_id, on_hand_qty FROM inventory_fact WHERE {RECENT_INVENTORY}"""))
def recent_inventory(v):
    df = recent(v.inventory_fact(), "inventory_ts", Period(v.inventory_as_of, MINUTES))
    return df.select("inventory_event_id", "sku_id", "dc_id", "on_hand_qty")


@query("older_orders", "A3", with_views("orders_fact", f"""
SELECT order_line_id, {sql_time('order_ts')} FROM orders_fact WHERE order_ts < {ORDERS_AS_OF} - INTERVAL {DAYS} DAY"""))
def older_orders(v):
    cutoff = v.orders_as_of - timedelta(days=DAYS)
    return tables.older_than(v.orders_fact(), "order_ts", cutoff).select("order_line_id", text_time("order_ts"))


@query("dimension_scan", "A4 D4", with_views("skus dcs regions", """
SELECT dc_id, dc_name, region_id, region_name, capacity_m3 FROM dcs LEFT JOIN regions USING (region_id)"""))
def dimension_scan(v):
    return v.dcs().join(v.regions(), "region_id", "left").select(
        "dc_id", "dc_name", "region_id", "region_name", "capacity_m3"
    )


@query("dimension_replace", "A8", with_views("skus", """
SELECT sku_id::VARCHAR AS sku_id, product_name, category, unit_cost, storage_m3, demand_base_lambda, lead_time_days,
 stock_coverage_days FROM skus"""))
def dimension_replace(v):
    path = scratch_path(v.spark, "skus_dim")
    for _ in range(2):
        tables.replace_table(v.skus(), path, schemas.SKUS_DIM)
    return tables.scan(v.spark, schemas.SKUS_DIM, path)


NEWEST = """SELECT '{table}' AS table_name, {id} AS event_id, strftime({ts}, '%Y-%m-%d %H:%M:%S') AS newest_ts
FROM (SELECT * FROM {table} ORDER BY {ts} DESC, {id} DESC LIMIT 1)"""


@query("latest_records", "A7", with_views(
    "orders_fact shipments_fact inventory_fact",
    "\nUNION ALL\n".join(
        NEWEST.format(table=t, id=i, ts=schemas.FACT_TIME[t])
        for t, i in {"orders_fact": "order_line_id", "shipments_fact": "shipment_id",
                     "inventory_fact": "inventory_event_id"}.items())))
def latest_records(v):
    facts = {
        "orders_fact": (v.orders_fact(), "order_line_id"),
        "shipments_fact": (v.shipments_fact(), "shipment_id"),
        "inventory_fact": (v.inventory_fact(), "inventory_event_id"),
    }
    out = None
    for name, (df, ident) in facts.items():
        ts = schemas.FACT_TIME[name]
        row = tables.latest_record(df.select(ident, ts), ts, [ident]).select(
            F.lit(name).alias("table_name"), F.col(ident).alias("event_id"),
            F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("newest_ts"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@query("latest_state", "A7 G6", with_views("inventory_state", f"""
SELECT sku_id, dc_id, on_hand_qty, safety_stock, reorder_point, {sql_time('last_updated')} FROM inventory_state"""))
def latest_state(v):
    return v.inventory_state().select(
        "sku_id", "dc_id", "on_hand_qty", "safety_stock", "reorder_point", text_time("last_updated")
    )


@query("time_range_and_counts", "E7 E8 A3", with_views("orders_fact shipments_fact inventory_fact", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, strftime(min({ts}), '%Y-%m-%d') AS first_day, "
    f"strftime(max({ts}), '%Y-%m-%d') AS last_day FROM {t}" for t, ts in schemas.FACT_TIME.items())))
def time_range_and_counts(v):
    facts = {"orders_fact": v.orders_fact(), "shipments_fact": v.shipments_fact(), "inventory_fact": v.inventory_fact()}
    out = None
    for name, df in facts.items():
        ts = schemas.FACT_TIME[name]
        row = df.agg(
            F.count("*").alias("row_count"), F.date_format(F.min(ts), "yyyy-MM-dd").alias("first_day"),
            F.date_format(F.max(ts), "yyyy-MM-dd").alias("last_day"),
        ).select(F.lit(name).alias("table_name"), "row_count", "first_day", "last_day")
        out = row if out is None else out.unionByName(row)
    return out


# Set operations -------------------------------------------------------------------


@query("hot_cold_union", "G1", f"""
SELECT event_type, count(*) AS events, round(sum(value), 2) AS total_value FROM events GROUP BY ALL""")
def hot_cold_union(v):
    """The tiers overlap by ten days, as after an archive run whose delete did not happen."""
    cutoff = v.events_as_of - timedelta(days=10)
    events = v.events()
    cold = tables.older_than(events, "ts", cutoff).withColumns(scalars.date_parts(F.col("ts")))
    both = setops.unify(events, cold, "event_id", "ts", cutoff)
    return rounded(
        both.groupBy("event_type").agg(F.count("*").alias("events"), F.sum("value").alias("total_value")), 2, "total_value"
    )


@query("deduplicated_events", "G6", """
SELECT event_id, user_id, event_type, value FROM events""")
def deduplicated_events(v):
    events = v.events().select("event_id", "user_id", "event_type", "value")
    return setops.drop_duplicate_events(events.unionByName(events), "event_id")


@query("unshipped_order_lines", "D8", with_views("orders_fact shipments_fact", """
SELECT order_line_id, count(*) AS "rows" FROM orders_fact
WHERE order_line_id NOT IN (SELECT shipment_id FROM shipments_fact) GROUP BY ALL"""))
def unshipped_order_lines(v):
    """Lines are matched by their own columns; ids are made for those that are left."""
    lines = v.order_lines().select(*LINE_KEYS, "o_orderdate")
    left = setops.missing_rows(lines, lines.where(F.col("l_shipdate") > F.col("o_orderdate")), LINE_KEYS)
    return left.groupBy(line_id().alias("order_line_id")).agg(F.count("*").alias("rows"))


# Scalar functions ---------------------------------------------------------------------


@query("event_date_parts", "H1", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS event_date, year(ts)::INT AS event_year, month(ts)::INT AS event_month,
 day(ts)::INT AS event_day, hour(ts)::INT AS event_hour FROM events""")
def event_date_parts(v):
    out = v.events().select("event_id", *[c.alias(n) for n, c in scalars.date_parts(F.col("ts")).items()])
    return out.withColumn("event_date", F.col("event_date").cast("string"))


@query("event_ages", "H10 H2", f"""
SELECT event_id, epoch(date_trunc('second', {EVENTS_AS_OF}))::BIGINT - epoch(date_trunc('second', ts))::BIGINT AS age_seconds,
 strftime(ts - INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_start FROM events""")
def event_ages(v):
    now = scalars.moment(v.events_as_of)
    return v.events().select(
        "event_id", scalars.age_seconds(F.col("ts"), now).alias("age_seconds"),
        F.date_format(scalars.before(F.col("ts"), 15), "yyyy-MM-dd HH:mm:ss").alias("window_start"),
    )


@query("iso_round_trip", "H7", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso, strftime(ts, '%Y-%m-%d %H:%M:%S') AS display FROM events""")
def iso_round_trip(v):
    iso = scalars.iso_text(F.col("ts"))
    zulu = v.events().select("event_id", iso.alias("iso"), F.concat(iso, F.lit("Z")).alias("z"))
    return zulu.select("event_id", "iso", scalars.display_time(F.col("z")).alias("display"))


@query("stable_event_ids", "H8 Q8", """
SELECT event_id, substr(h,1,8)||'-'||substr(h,9,4)||'-'||substr(h,13,4)||'-'||substr(h,17,4)||'-'||substr(h,21,12) AS stable_id,
 true AS well_formed, false AS raw_well_formed
FROM (SELECT event_id, sha256(event_id || '|' || user_id || '|' || event_type) AS h FROM events)""")
def stable_event_ids(v):
    ident = scalars.stable_id(F.col("event_id"), F.col("user_id"), F.col("event_type"))
    return v.events().select("event_id", ident.alias("stable_id")).select(
        "event_id", "stable_id", scalars.is_uuid(F.col("stable_id")).alias("well_formed"),
        scalars.is_uuid(F.col("event_id")).alias("raw_well_formed"),
    )


@query("safe_arithmetic", "H3 H5 H11 C6", with_views("skus", """
SELECT sku_id, round(unit_cost / nullif(demand_base_lambda % 10, 0), 6) AS safe_ratio,
 trunc(unit_cost)::INT AS whole_cost, greatest(5, least(25, demand_base_lambda))::INT AS clamped,
 round(storage_m3, 2) AS short_storage FROM skus"""))
def safe_arithmetic(v):
    out = v.skus().select(
        "sku_id", scalars.ratio(F.col("unit_cost"), F.col("demand_base_lambda") % 10).alias("safe_ratio"),
        scalars.whole(F.col("unit_cost")).alias("whole_cost"),
        scalars.clamp(F.col("demand_base_lambda"), 5, 25).alias("clamped"),
        F.round("storage_m3", 2).alias("short_storage"),
    )
    return rounded(out, 6, "safe_ratio")


@query("formatted_numbers", "H9", """
SELECT o_orderkey AS order_id, format('{:,.0f}', o_totalprice) AS whole_price,
 CASE WHEN o_totalprice >= 1000000 THEN printf('%.2f', o_totalprice / 1000000) || 'M'
  WHEN o_totalprice >= 1000 THEN printf('%.1f', o_totalprice / 1000) || 'K' ELSE format('{:,.0f}', o_totalprice) END AS compact
FROM orders""")
def formatted_numbers(v):
    price = F.col("o_totalprice")
    return v.table("orders").select(
        F.col("o_orderkey").alias("order_id"), scalars.thousands(price).alias("whole_price"),
        scalars.compact_number(price).alias("compact"),
    )


@query("json_round_trip", "H6", """
SELECT event_id, event_type, value, json_extract(props, '$.k')::INT AS k FROM events""")
def json_round_trip(v):
    text = F.to_json(F.struct("event_id", "event_type", "value"))
    parsed = F.from_json("payload", "event_id bigint, event_type string, value double")
    return (
        v.events().select(text.alias("payload"), F.from_json("props", "k int").alias("p"))
        .select(parsed.alias("r"), "p").select("r.*", "p.k")
    )
