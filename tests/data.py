"""Small frames in the schemas of the domain tables."""

from datetime import datetime, timedelta

from quaymaster import schemas

NOW = datetime(2025, 3, 1, 12, 0, 0)


def minutes_ago(n):
    return NOW - timedelta(minutes=n)


def make(spark, table, *rows, **defaults):
    """Rows given as dicts; columns that are not given are null."""
    schema = schemas.TABLES[table]
    names = schema.fieldNames()
    return spark.createDataFrame([tuple({**defaults, **r}.get(n) for n in names) for r in rows], schema)


def inventory(spark, *rows):
    return make(spark, "inventory_fact", *rows, inventory_ts=minutes_ago(1), safety_stock=10, reorder_point=20)


def orders(spark, *rows):
    return make(spark, "orders_fact", *rows, order_ts=minutes_ago(1), order_value=10.0, quantity=1)


def shipments(spark, *rows):
    return make(spark, "shipments_fact", *rows, shipment_ts=minutes_ago(1), quantity=5)


def skus(spark, *rows):
    return make(
        spark, "skus_dim", *rows, product_name="thing", category="c", unit_cost=2.0, storage_m3=0.5,
        demand_base_lambda=10, lead_time_days=2, stock_coverage_days=5,
    )


def dcs(spark, *rows):
    return make(spark, "dcs_dim", *rows, dc_name="center", region_id="R1", capacity_m3=100)


def regions(spark):
    return make(spark, "regions_dim", {"region_id": "R1", "region_name": "North"})


def suppliers(spark, *rows):
    return make(spark, "suppliers_dim", *rows, supplier_name="Sup", reliability_score=0.9, avg_lead_time_days=4.0)
