from datetime import timedelta

from pyspark.sql import functions as F

import data
from quaymaster.operators import quality, setops
from quaymaster.session import scratch_path
from quaymaster.sinks import archive
from quaymaster.sources.tables import keep_latest, latest_record

GOOD = "0b9e4f0a-5f4c-4f4e-9a53-0d2f4b8f0c11"


def violations(df):
    return {r["rule"]: (r["checked"], r["violations"]) for r in df.collect()}


def test_order_rules(spark):
    fine = {"order_id": GOOD, "requested_qty": 5, "fulfilled_qty": 3, "lost_sales_qty": 2, "priority_level": "HIGH"}
    bad = {"order_id": "7", "requested_qty": 1, "fulfilled_qty": 3, "lost_sales_qty": 2, "priority_level": "SOON", "order_value": -1.0}
    got = violations(quality.check_rules(data.orders(spark, fine, bad), "orders_fact", quality.orders_rules()))
    assert got == {
        "fulfilled_within_requested": (2, 1), "lost_is_requested_minus_fulfilled": (2, 1), "order_value_not_negative": (2, 1),
        "priority_known": (2, 1), "order_id_is_uuid": (2, 1),
    }


def test_inventory_and_shipment_rules(spark):
    stock = data.inventory(spark, {"inventory_event_id": GOOD, "on_hand_qty": -1}, {"inventory_event_id": GOOD, "on_hand_qty": 0})
    assert violations(quality.check_rules(stock, "inventory_fact", quality.inventory_rules())) == {
        "on_hand_not_negative": (2, 1), "inventory_id_is_uuid": (2, 0),
    }
    sent = data.shipments(
        spark, {"shipment_id": GOOD, "quantity": 0, "expected_arrival_ts": data.NOW, "actual_arrival_ts": data.minutes_ago(1)},
        {"shipment_id": GOOD, "expected_arrival_ts": data.NOW},
    )
    assert violations(quality.check_rules(sent, "shipments_fact", quality.shipments_rules())) == {
        "arrival_not_before_expected": (2, 1), "quantity_positive": (2, 1), "shipment_id_is_uuid": (2, 0),
    }


def test_reference_check_counts_rows(spark):
    sold = data.orders(spark, {"sku_id": "S"}, {"sku_id": "X"}, {"sku_id": "X"}, {"sku_id": None})
    skus = data.skus(spark, {"sku_id": "S"})
    row = quality.check_reference(sold, "orders_fact", skus, "sku_id").first()
    assert tuple(row) == ("orders_fact", "sku_id_exists", 3, 2)
    assert [tuple(r) for r in setops.orphans(sold, skus, "sku_id").collect()] == [("X", 2)]


def test_all_references_of_a_fact_in_one_pass(spark):
    sold = data.orders(spark, *[{"sku_id": s, "dc_id": d} for s, d in [("S", "D"), ("X", "D"), ("X", None), (None, "E"), ("S", "E")]])
    references = [quality.Reference("sku_id", data.skus(spark, {"sku_id": "S"}, {"sku_id": "S"})),
                  quality.Reference("dc_id", data.dcs(spark, {"dc_id": "D"})),
                  quality.Reference("order_id", data.skus(spark), "sku_id")]
    report = quality.check_references(sold, "orders_fact", references)
    assert violations(report) == {"sku_id_exists": (4, 2), "dc_id_exists": (4, 2), "order_id_exists": (0, 0)}
    # One exchange of the fact's counted keys, whatever the number of references.
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode(array(struct") == 1
    assert violations(quality.check_references(sold.limit(0), "orders_fact", references)) == {
        "sku_id_exists": (0, 0), "dc_id_exists": (0, 0), "order_id_exists": (0, 0)}


def test_rows_without_their_match(spark):
    sold = data.orders(spark, {"sku_id": "S", "dc_id": "D"}, {"sku_id": "S", "dc_id": "E"}, {"sku_id": None, "dc_id": "D"})
    left = setops.missing_rows(sold, sold.where("dc_id = 'D'"), ["sku_id", "dc_id"])
    assert sorted((r["sku_id"] or "", r["dc_id"]) for r in left.collect()) == [("", "D"), ("S", "E")]


def test_rules_are_counted_while_rows_are_archived(spark):
    rows = data.shipments(spark, *[
        {"shipment_id": GOOD if i else "bad id", "quantity": i - 1, "shipment_ts": data.minutes_ago(300 + i), "supplier_id": f"s{i}",
         "sku_id": f"k{i}", "lead_time_days": float(i)} for i in range(4)]).withColumn("shipment_id", F.concat("shipment_id", F.lit("")))
    table = archive.ArchiveTable("shipments_fact", rows, "shipment_ts", "sku_id", None, tuple(quality.shipments_rules()))
    base = scratch_path(spark, "rules")
    for _ in range(2):  # the second run archives nothing and counts nothing
        stats, errors = archive.run_archive(spark, [table], base, data.NOW)
        assert errors == {}
    report = archive.read_rule_report(spark, base)
    assert violations(report) == {"arrival_not_before_expected": (4, 0), "quantity_positive": (4, 2), "shipment_id_is_uuid": (4, 1)}
    broken = archive.read_broken(spark, f"{base}/shipments_fact", rows.schema.fields, "sku_id")
    assert {r["sku_id"]: r["broken_rules"] for r in broken.collect()} == {"k0": ["quantity_positive", "shipment_id_is_uuid"], "k1": ["quantity_positive"]}
    assert archive.read_archive(spark, f"{base}/shipments_fact", rows.schema.fields).count() == 4
    assert archive.read_broken(spark, f"{base}/elsewhere", rows.schema.fields, "sku_id") is None


def test_volumes_and_archive_decision(spark):
    volumes = quality.volume_report({"a": spark.range(1_000_000), "b": spark.range(10)})
    got = {r["table_name"]: tuple(r)[1:] for r in volumes.collect()}
    assert got == {"a": (1_000_000, 476.84, 158.9), "b": (10, 0.0, 0.0)}
    assert quality.archive_needed(volumes).first()["decision"] == "trigger_archival"
    assert quality.archive_needed(volumes, 500).first()["decision"] == "skip_archival"
    effect = quality.archive_effect(spark.range(1_000_000), spark.range(250_000)).first()
    assert tuple(effect) == (1_000_000, 250_000, 476.84, 119.21, 357.63, 75.0)
    assert quality.archive_effect(spark.range(0), spark.range(0)).first()["freed_pct"] is None


def test_freshness(spark):
    facts = {
        "orders_fact": (data.orders(spark, {"order_ts": data.minutes_ago(3)}), "order_ts"),
        "shipments_fact": (data.shipments(spark, {"shipment_ts": data.minutes_ago(30)}), "shipment_ts"),
        "inventory_fact": (data.inventory(spark), "inventory_ts"),
    }
    got = {r["table_name"]: (r["age_seconds"], r["stale"]) for r in quality.fact_freshness(facts, data.NOW).collect()}
    assert got == {"orders_fact": (180, True), "shipments_fact": (1800, False), "inventory_fact": (None, False)}
    texts = [("2025-03-01T11:58:01Z",), ("2025-03-01T11:58:00",), ("garbage",), (None,)]
    updates = spark.createDataFrame(texts, "last_update string")
    assert [r["freshness"] for r in quality.kpi_freshness(updates, data.NOW).collect()] == ["Fresh", "Stale", "Unknown", "Unknown"]


def test_latest_rows(spark, rows):
    sold = data.orders(
        spark, {"order_id": "a", "quantity": 1, "order_ts": data.minutes_ago(2)}, {"order_id": "b", "quantity": 2},
        {"order_id": "a", "quantity": 3, "order_ts": data.NOW + timedelta(minutes=1)},
    ).select("order_id", "quantity", "order_ts")
    assert rows(latest_record(sold, "order_ts", ["order_id"])) == [("a", 3, data.NOW + timedelta(minutes=1))]
    assert sorted(r[:2] for r in rows(keep_latest(sold, ["order_id"], ["order_ts"]))) == [("a", 3), ("b", 2)]
    assert latest_record(sold.limit(0), "order_ts", ["order_id"]).count() == 0
    assert setops.drop_duplicate_events(sold.unionByName(sold), "order_id").count() == 2
