"""Explicit schemas of the facts, dimensions, state, archive and serving tables."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    """Schema from ``name type`` pairs, without needing a session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


ORDERS_FACT = _struct(
    "order_id string, sku_id string, dc_id string, region_id string, requested_qty int, "
    "fulfilled_qty int, lost_sales_qty int, quantity int, lost_sale_flag boolean, "
    "order_value double, lost_revenue double, priority_level string, order_ts timestamp"
)
INVENTORY_FACT = _struct(
    "inventory_event_id string, sku_id string, dc_id string, on_hand_qty int, "
    "safety_stock int, reorder_point int, inventory_ts timestamp"
)
SHIPMENTS_FACT = _struct(
    "shipment_id string, sku_id string, supplier_id string, destination_dc_id string, "
    "quantity int, shipment_ts timestamp, expected_arrival_ts timestamp, "
    "actual_arrival_ts timestamp, lead_time_days double, shipment_type string"
)
SKUS_DIM = _struct(
    "sku_id string, product_name string, category string, unit_cost double, storage_m3 double, "
    "demand_base_lambda int, lead_time_days int, stock_coverage_days int"
)
DCS_DIM = _struct(
    "dc_id string, dc_name string, region_id string, capacity_m3 int, "
    "throughput_per_day int, operating_cost_per_day double"
)
REGIONS_DIM = _struct(
    "region_id string, region_name string, demand_factor double, demand_volatility double"
)
SUPPLIERS_DIM = _struct(
    "supplier_id string, supplier_name string, reliability_score double, "
    "avg_lead_time_days double, lead_time_stddev_days double, supplier_type string"
)
INVENTORY_STATE = _struct(
    "sku_id string, dc_id string, on_hand_qty int, safety_stock int, reorder_point int, "
    "base_stock int, stock_coverage_days int, last_updated timestamp"
)
ARCHIVE_PARTS = _struct(
    "event_date date, event_year int, event_month int, event_day int, event_hour int"
)
ARCHIVE_STATS = _struct("collection string, record_count bigint, size_mb double").add(
    "date_range", _struct("min string, max string")
)
SERVING = _struct(
    "kpi_key string, position bigint, payload string, updated_at timestamp, expires_at timestamp"
)

TABLES = {
    "orders_fact": ORDERS_FACT,
    "inventory_fact": INVENTORY_FACT,
    "shipments_fact": SHIPMENTS_FACT,
    "skus_dim": SKUS_DIM,
    "dcs_dim": DCS_DIM,
    "regions_dim": REGIONS_DIM,
    "suppliers_dim": SUPPLIERS_DIM,
    "inventory_state": INVENTORY_STATE,
}

# The benchmark tables from which the domain views are derived.
BENCHMARK = {
    "region": _struct("r_regionkey int, r_name string"),
    "nation": _struct("n_nationkey int, n_name string, n_regionkey int"),
    "customer": _struct(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": _struct("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "part": _struct(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": _struct(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": _struct(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": _struct(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}

FACT_TIME = {
    "orders_fact": "order_ts",
    "shipments_fact": "shipment_ts",
    "inventory_fact": "inventory_ts",
}
FACT_ID = {
    "orders_fact": "order_id",
    "shipments_fact": "shipment_id",
    "inventory_fact": "inventory_event_id",
}


def archived(schema: T.StructType) -> T.StructType:
    """Schema of a fact in the archive: its columns, then the date parts."""
    return T.StructType(schema.fields + ARCHIVE_PARTS.fields)
