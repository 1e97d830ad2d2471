from datetime import timedelta

import pytest

import data
from quaymaster.jobs import archive, compact, kpis, monitor
from quaymaster.session import scratch_path
from quaymaster.sinks import serving
from quaymaster.sources.tables import scan_archive

AS_OF = ["--as-of", data.NOW.isoformat()]
PAIR = {"sku_id": "SKU-A", "dc_id": "DC-A"}


@pytest.fixture
def tables(spark):
    """Hot tables of the reference network: recent and old rows."""
    base = scratch_path(spark, "hot")
    dims = {
        "regions_dim": data.make(spark, "regions_dim", {"region_id": "R", "region_name": "North"}),
        "dcs_dim": data.dcs(spark, {"dc_id": "DC-A", "region_id": "R"}),
        "skus_dim": data.skus(spark, {"sku_id": "SKU-A", "product_name": "Green Tea"}),
        "suppliers_dim": data.suppliers(spark, {"supplier_id": "SUP-A"}),
    }
    for name, df in dims.items():
        df.write.parquet(f"{base}/{name}")
    old = data.minutes_ago(300)
    facts = {
        "orders_fact": data.orders(
            spark, {**PAIR, "order_id": "new", "quantity": 100, "order_value": 500.0}, {**PAIR, "order_id": "old", "order_ts": old}
        ),
        "inventory_fact": data.inventory(
            spark, {**PAIR, "inventory_event_id": "new", "on_hand_qty": 9}, {**PAIR, "inventory_event_id": "old", "on_hand_qty": 99, "inventory_ts": old}
        ),
        "shipments_fact": data.shipments(
            spark, {"shipment_id": "new", "supplier_id": "SUP-A", "lead_time_days": 2.0},
            {"shipment_id": "open", "supplier_id": "SUP-A", "shipment_ts": old},
        ),
    }
    for name, df in facts.items():
        df.write.parquet(f"{base}/{name}")
    return base


def test_kpi_job_publishes_the_window(spark, tables):
    out = scratch_path(spark, "serving")
    kpis.main(["--tables", tables, "--serving", out, *AS_OF])
    table = serving.read_serving(spark, out)
    level = serving.read_records(table, serving.INVENTORY_KEY, "product_name string, current_inventory int", data.NOW).collect()
    assert [tuple(r) for r in level] == [(None, "Green Tea", 9)]
    alert = serving.read_records(table, serving.STOCKOUT_KEY, "severity string, days_until_stockout double", data.NOW).first()
    assert tuple(alert) == (None, "Critical", 0.0)
    regional = serving.read_records(table, serving.REGIONAL_KEY, "region_name string, revenue double", data.NOW).first()
    assert tuple(regional) == (None, "North", 500.0)
    values = serving.read_values(table, [serving.STOCKOUT_COUNT_KEY, serving.WINDOW_KEY], data.NOW).collect()
    assert {r["kpi_key"]: r["value"] for r in values} == {serving.STOCKOUT_COUNT_KEY: "1", serving.WINDOW_KEY: "15"}


def test_archive_job_moves_old_closed_rows(spark, tables):
    cold, kept = scratch_path(spark, "cold"), scratch_path(spark, "kept")
    archive.main(["--tables", tables, "--archive", cold, "--kept", kept, *AS_OF])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{cold}/orders_fact")
    archive.main(["--tables", tables, "--archive", cold, "--kept", kept, "--threshold-mb", "-1", *AS_OF])
    assert [r["order_id"] for r in scan_archive(spark, cold, "orders_fact").collect()] == ["old"]
    assert [r["order_id"] for r in spark.read.parquet(f"{kept}/orders_fact").collect()] == ["new"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{cold}/shipments_fact")


def test_kpi_job_unites_hot_and_archive(spark, tables):
    cold, out = scratch_path(spark, "cold"), scratch_path(spark, "serving")
    archive.main(["--tables", tables, "--archive", cold, "--threshold-mb", "-1", *AS_OF])
    kpis.main(["--tables", tables, "--serving", out, "--archive", cold, "--window-minutes", "600", *AS_OF])
    table = serving.read_serving(spark, out)
    level = serving.read_records(table, serving.INVENTORY_KEY, "current_inventory int", data.NOW).first()
    assert level["current_inventory"] == 54
    assert serving.live(table, data.NOW + timedelta(minutes=2)).count() == 0


def test_monitor_job_writes_reports(spark, tables):
    out = scratch_path(spark, "reports")
    monitor.main(["--tables", tables, "--reports", out, *AS_OF])
    volume = {r["table_name"]: r["row_count"] for r in spark.read.json(f"{out}/volume").collect()}
    assert volume["orders_fact"] == 2 and volume["skus_dim"] == 1
    rules = {r["rule"]: r["violations"] for r in spark.read.json(f"{out}/quality").collect()}
    assert rules["order_id_is_uuid"] == 2 and rules["supplier_id_exists"] == 0
    assert {r["table_name"]: r["age_seconds"] for r in spark.read.json(f"{out}/freshness").collect()}["orders_fact"] == 60


def test_compaction_job_merges_and_expires(spark, tables):
    cold = scratch_path(spark, "cold")
    for minutes in (280, 120):
        archive.main(["--tables", tables, "--archive", cold, "--threshold-mb", "-1", "--older-than-minutes", str(minutes), *AS_OF])
    extra = data.orders(spark, {**PAIR, "order_id": "late", "order_ts": data.minutes_ago(299)})
    extra.write.mode("append").parquet(f"{tables}/orders_fact")
    archive.main(["--tables", tables, "--archive", cold, "--threshold-mb", "-1", *AS_OF])
    for expire in ([], ["--expire"], []):
        compact.main(["--archive", cold, *expire])
        assert sorted(r["order_id"] for r in scan_archive(spark, cold, "orders_fact").collect()) == ["late", "old"]
    rules = {r["rule"]: r["violations"] for r in spark.read.json(f"{cold}/rules").where("table_name = 'orders_fact'").collect()}
    assert rules["order_id_is_uuid"] >= 1
