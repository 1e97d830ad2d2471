"""Reference SQL of the domain views, shared by the SQL of the queries."""

from __future__ import annotations

ROW_ID = (
    "(substr(h,1,8)||'-'||substr(h,9,4)||'-'||substr(h,13,4)||'-'||substr(h,17,4)||'-'||substr(h,21,12))"
)

LINE_HASH = (
    "sha256(l_orderkey||'|'||l_linenumber||'|'||l_partkey||'|'||l_suppkey||'|'||l_quantity::INT"
    "||'|'||strftime(l_shipdate, '%Y-%m-%d'))"
)

VIEWS = {
    "regions": "SELECT r_regionkey AS region_id, r_name AS region_name FROM region",
    "dcs": "SELECT n_nationkey AS dc_id, n_name AS dc_name, n_regionkey AS region_id, "
    "50.0::DOUBLE + n_nationkey AS capacity_m3 FROM nation",
    "skus": "SELECT p_partkey AS sku_id, p_name AS product_name, p_type AS category, p_retailprice AS unit_cost, "
    "p_size::DOUBLE / 1000 AS storage_m3, p_size AS demand_base_lambda, 1 + p_size % 5 AS lead_time_days, "
    "3 + p_size % 43 AS stock_coverage_days FROM part",
    "suppliers": "SELECT s_suppkey AS supplier_id, s_name AS supplier_name, "
    "(80 + s_suppkey % 20)::DOUBLE / 100 AS reliability_score, "
    "(1 + s_suppkey % 7)::DOUBLE AS avg_lead_time_days FROM supplier",
    "order_lines": f"SELECT *, {LINE_HASH} AS h "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey",
    "orders_fact": f"SELECT {ROW_ID} AS order_line_id, l_orderkey AS order_id, l_partkey AS sku_id, c_nationkey AS dc_id, "
    "l_quantity::INT AS requested_qty, least(l_quantity::INT, 40) AS fulfilled_qty, "
    "greatest(l_quantity::INT - 40, 0) AS lost_sales_qty, l_quantity::INT AS quantity, "
    "l_quantity > 40 AS lost_sale_flag, (l_extendedprice * (1 - l_discount))::DECIMAL(18,4) AS order_value, "
    "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'HIGH' "
    "WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'NORMAL' ELSE 'LOW' END AS priority_level, "
    "o_orderdate AS order_ts FROM order_lines",
    "shipments_fact": f"SELECT {ROW_ID} AS shipment_id, l_partkey AS sku_id, l_suppkey AS supplier_id, "
    "c_nationkey AS destination_dc_id, l_quantity::INT AS quantity, o_orderdate AS shipment_ts, "
    "l_shipdate AS expected_arrival_ts, l_shipdate AS actual_arrival_ts, "
    "date_diff('day', o_orderdate, l_shipdate)::DOUBLE AS lead_time_days FROM order_lines WHERE l_shipdate > o_orderdate",
    "inventory_fact": f"SELECT {ROW_ID} AS inventory_event_id, l_partkey AS sku_id, s_nationkey AS dc_id, "
    "l_quantity::INT AS on_hand_qty, p_size % 20 AS safety_stock, p_size % 20 + 10 AS reorder_point, "
    f"l_shipdate AS inventory_ts FROM (SELECT *, {LINE_HASH} AS h "
    "FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey",
    "inventory_state": "SELECT sku_id, dc_id, on_hand_qty, safety_stock, reorder_point, inventory_ts AS last_updated "
    "FROM (SELECT *, row_number() OVER (PARTITION BY sku_id, dc_id ORDER BY inventory_ts DESC, on_hand_qty DESC) AS rn "
    "FROM inventory_fact) WHERE rn = 1",
}

NEEDS = {
    "orders_fact": ["order_lines"],
    "shipments_fact": ["order_lines"],
    "inventory_state": ["inventory_fact"],
}


def with_views(names: str, body: str, **ctes: str) -> str:
    """``body`` after the named views and any further common table expressions."""
    chosen: dict[str, str] = {}
    for name in names.split():
        for needed in [*NEEDS.get(name, []), name]:
            chosen[needed] = VIEWS[needed]
    chosen.update(ctes)
    if not chosen:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in chosen.items()) + "\n" + body
