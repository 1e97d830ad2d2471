"""Quality, volume and freshness queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from quaymaster import schemas
from quaymaster.operators import quality
from quaymaster.operators.quality import Rule
from quaymaster.plans.registry import DAYS, INVENTORY_AS_OF, ORDERS_AS_OF, query
from quaymaster.plans.sql import LINE_HASH, ROW_ID, with_views
from quaymaster.session import scratch_path
from quaymaster.sinks.archive import ArchiveTable, append_new, read_broken, read_rule_report, retained, run_archive
from quaymaster.sources.retail_views import RetailViews, line_id

UUID = "'^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$'"

# (table, rule, violated) of every rule, as SQL.
RULES = [
    ("orders_fact", "fulfilled_within_requested", "fulfilled_qty > requested_qty"),
    ("orders_fact", "lost_is_requested_minus_fulfilled", "lost_sales_qty <> requested_qty - fulfilled_qty"),
    ("orders_fact", "order_value_not_negative", "order_value < 0"),
    ("orders_fact", "priority_known", "priority_level NOT IN ('HIGH', 'NORMAL', 'LOW')"),
    ("orders_fact", "order_id_is_uuid", f"NOT regexp_matches(order_line_id, {UUID})"),
    ("inventory_fact", "on_hand_not_negative", "on_hand_qty < 0"),
    ("inventory_fact", "inventory_id_is_uuid", f"NOT regexp_matches(inventory_event_id, {UUID})"),
    ("shipments_fact", "arrival_not_before_expected", "actual_arrival_ts < expected_arrival_ts"),
    ("shipments_fact", "quantity_positive", "quantity <= 0"),
    ("shipments_fact", "shipment_id_is_uuid", f"NOT regexp_matches(shipment_id, {UUID})"),
]
REFERENCES = [
    ("orders_fact", "sku_id", "skus", "sku_id"),
    ("orders_fact", "dc_id", "dcs", "dc_id"),
    ("inventory_fact", "sku_id", "skus", "sku_id"),
    ("inventory_fact", "dc_id", "dcs", "dc_id"),
    ("shipments_fact", "sku_id", "skus", "sku_id"),
    ("shipments_fact", "supplier_id", "suppliers", "supplier_id"),
    ("shipments_fact", "destination_dc_id", "dcs", "dc_id"),
]
FACTS = "orders_fact shipments_fact inventory_fact"


def rule_sql(rows):
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{r}' AS rule, count(*) AS checked, count(*) FILTER ({c}) AS violations FROM {t}"
        for t, r, c in rows
    )


def reference_sql(rows):
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{k}_exists' AS rule, count({k}) AS checked, "
        f"count(*) FILTER ({k} NOT IN (SELECT {dk} FROM {d})) AS violations FROM {t}"
        for t, k, d, dk in rows
    )


def facts(v: RetailViews):
    return {"orders_fact": v.orders_fact(), "shipments_fact": v.shipments_fact(), "inventory_fact": v.inventory_fact()}


def rule_parts(v: RetailViews):
    f = facts(v)
    return [
        quality.check_rules(f["orders_fact"], "orders_fact", quality.orders_rules("order_line_id")),
        quality.check_rules(f["inventory_fact"], "inventory_fact", quality.inventory_rules()),
        quality.check_rules(f["shipments_fact"], "shipments_fact", quality.shipments_rules()),
    ]


def reference_parts(v: RetailViews):
    dims = {"skus": v.skus(), "dcs": v.dcs(), "suppliers": v.suppliers()}
    return [
        quality.check_references(fact, name, [quality.Reference(k, dims[d], dk) for t, k, d, dk in REFERENCES if t == name])
        for name, fact in facts(v).items()
    ]


@query("quality_report", "Q1 Q2 Q3 Q4 Q5 Q6 Q7 Q8 Q11", with_views(FACTS, rule_sql(RULES)))
def quality_report(v):
    return quality.quality_report(rule_parts(v))


@query("reference_report", "Q10 D8", with_views(f"{FACTS} skus dcs suppliers", reference_sql(REFERENCES)))
def reference_report(v):
    return quality.quality_report(reference_parts(v))


@query("range_report", "Q9 Q1 Q5 Q6", """
SELECT 'lineitem' AS table_name, rule, checked, violations FROM (
 SELECT 'quantity_range' AS rule, count(*) AS checked, count(*) FILTER (l_quantity NOT BETWEEN 5 AND 45) AS violations FROM lineitem
 UNION ALL SELECT 'discount_range', count(*), count(*) FILTER (l_discount NOT BETWEEN 0.02 AND 0.08) FROM lineitem
 UNION ALL SELECT 'shipped_in_range', count(*), count(*) FILTER (l_shipdate NOT BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31') FROM lineitem)""")
def range_report(v):
    lines = v.table("lineitem")
    day = lambda text: F.lit(text).cast("timestamp_ntz")
    return quality.check_rules(
        lines, "lineitem",
        [
            quality.range_rule("quantity_range", "l_quantity", 5, 45),
            quality.range_rule("discount_range", "l_discount", 0.02, 0.08),
            quality.range_rule("shipped_in_range", "l_shipdate", day("1996-01-01"), day("2000-12-31")),
        ],
    )


@query("raw_rule_violations", "Q4 Q7 Q8", """
SELECT 'order_lines' AS table_name, 'arrival_not_before_expected' AS rule, count(*) AS checked,
 count(*) FILTER (l_shipdate < o_orderdate) AS violations FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT 'order_lines', 'priority_known', count(*), count(*) FILTER (o_orderpriority NOT IN ('HIGH', 'NORMAL', 'LOW'))
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT 'order_lines', 'order_id_is_uuid', count(*), count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def raw_rule_violations(v):
    """The same rules over rows that break them: order lines as they are in the tables."""
    raw = v.table("lineitem").join(v.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_shipdate").alias("actual_arrival_ts"), F.col("o_orderdate").alias("expected_arrival_ts"),
        F.col("o_orderpriority").alias("priority_level"), F.col("l_orderkey").alias("order_id"),
    )
    wanted = {"arrival_not_before_expected", "priority_known", "order_id_is_uuid"}
    rules: list[Rule] = [r for r in quality.shipments_rules("order_id") + quality.orders_rules() if r.name in wanted]
    return quality.check_rules(raw, "order_lines", rules)


RAW_TABLE = "order_lines"
RAW_DUE = f"""SELECT {LINE_HASH} AS h, l_shipdate < o_orderdate AS late, o_orderpriority NOT IN ('HIGH', 'NORMAL', 'LOW') AS unknown
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate < {ORDERS_AS_OF} - INTERVAL {DAYS} DAY"""


def archived_raw_lines(v: RetailViews):
    """Base of an archive of order lines as they are in the tables, checked as they are archived."""
    rows = v.table("lineitem").join(v.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        line_id().alias("line_id"), F.col("l_shipdate").alias("actual_arrival_ts"), F.col("o_orderdate").alias("expected_arrival_ts"),
        F.col("o_orderpriority").alias("priority_level"))
    wanted = {"arrival_not_before_expected", "priority_known", "shipment_id_is_uuid"}
    rules = tuple(r for r in quality.shipments_rules("line_id") + quality.orders_rules() if r.name in wanted)
    table = ArchiveTable(RAW_TABLE, rows, "expected_arrival_ts", "line_id", None, rules)
    base = scratch_path(v.spark, "checked-archive")
    _, errors = run_archive(v.spark, [table], base, v.orders_as_of, DAYS * 1440)
    if errors:
        raise RuntimeError(str(errors))
    return base, rows.schema


@query("archive_rule_report", "Q11 B1", with_views("", f"""
SELECT '{RAW_TABLE}' AS table_name, rule, count(*) AS checked, sum(broken::INT)::BIGINT AS violations FROM (
 SELECT DISTINCT 'arrival_not_before_expected' AS rule, h, late AS broken FROM due UNION ALL SELECT DISTINCT 'priority_known', h, unknown FROM due
 UNION ALL SELECT DISTINCT 'shipment_id_is_uuid', h, false FROM due) GROUP BY rule""", due=RAW_DUE))
def archive_rule_report(v):
    """Violations among archived rows, counted by the pass that archives them."""
    base, _ = archived_raw_lines(v)
    return read_rule_report(v.spark, base)


@query("archive_broken_rows", "Q11 B1", with_views("", f"""
SELECT DISTINCT {ROW_ID} AS line_id, concat_ws(',', CASE WHEN late THEN 'arrival_not_before_expected' END, CASE WHEN unknown THEN 'priority_known' END)
 AS broken_rules FROM due WHERE late OR unknown""", due=RAW_DUE))
def archive_broken_rows(v):
    """Archived rows that break a rule, set apart with the rules they break."""
    base, schema = archived_raw_lines(v)
    rows = read_broken(v.spark, f"{base}/{RAW_TABLE}", schema.fields, "line_id")
    return rows.select("line_id", F.array_join("broken_rules", ",").alias("broken_rules"))


# Volumes ------------------------------------------------------------------------

VOLUME_TABLES = ["orders_fact", "shipments_fact", "inventory_fact", "regions", "dcs", "skus", "suppliers"]
SIZE = "round(row_count * 500 / 1048576.0, 2)::DOUBLE"


def volume_tables(v: RetailViews):
    return {**facts(v), "regions": v.regions(), "dcs": v.dcs(), "skus": v.skus(), "suppliers": v.suppliers()}


COUNTS = "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in VOLUME_TABLES)


@query("volume_report", "Q12 E8 E15", with_views(" ".join(VOLUME_TABLES), f"""
SELECT table_name, row_count, {SIZE} AS size_mb, round({SIZE} / 300.0 * 100, 1) AS progress_pct FROM counts""",
    counts=COUNTS))
def volume_report(v):
    return quality.volume_report(volume_tables(v))


@query("archive_needed", "Q15 E15 E16", with_views(" ".join(VOLUME_TABLES), f"""
SELECT row_count, {SIZE} AS size_mb, 30.0::DOUBLE AS threshold_mb, round({SIZE} / 30.0 * 100, 1) AS progress_pct,
 CASE WHEN {SIZE} > 30 THEN 'trigger_archival' ELSE 'skip_archival' END AS decision
FROM (SELECT sum(row_count)::BIGINT AS row_count FROM counts)""", counts=COUNTS))
def archive_needed(v):
    return quality.archive_needed(quality.volume_report(volume_tables(v)), quality.DEMO_THRESHOLD_MB)


@query("archive_effect", "Q16 B6", with_views("orders_fact", f"""
SELECT rows_before, rows_after, b AS size_before_mb, a AS size_after_mb, round(b - a, 2) AS freed_mb,
 round((b - a) / nullif(b, 0) * 100, 1) AS freed_pct
FROM (SELECT count(*) AS rows_before, count(*) FILTER (keep) AS rows_after,
 round(count(*) * 500 / 1048576.0, 2)::DOUBLE AS b, round(count(*) FILTER (keep) * 500 / 1048576.0, 2)::DOUBLE AS a
 FROM (SELECT order_ts >= {ORDERS_AS_OF} - INTERVAL {DAYS} DAY AS keep FROM orders_fact))"""))
def archive_effect(v):
    table = ArchiveTable("orders_fact", v.orders_fact(), "order_ts", "order_line_id")
    base, cutoff = scratch_path(v.spark, "archive-effect"), v.orders_as_of - timedelta(days=DAYS)
    append_new(table, base, cutoff)
    return quality.archive_effect(v.orders_fact(), retained(table, base, cutoff))


# Freshness -------------------------------------------------------------------------


@query("fact_freshness", "Q13 A7 H10", with_views(FACTS, "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, epoch({INVENTORY_AS_OF})::BIGINT - epoch(max({ts}))::BIGINT AS age_seconds, "
    + (f"epoch({INVENTORY_AS_OF}) - epoch(max({ts})) > 120" if t == "orders_fact" else "false")
    + f" AS stale FROM {t}" for t, ts in schemas.FACT_TIME.items())))
def fact_freshness(v):
    timed = {name: (df, schemas.FACT_TIME[name]) for name, df in facts(v).items()}
    return quality.fact_freshness(timed, v.inventory_as_of)


@query("kpi_freshness", "Q14 H7 H10", """
SELECT event_id, last_update, CASE WHEN event_type = 'error' THEN NULL ELSE age END AS age_seconds,
 CASE WHEN event_type = 'error' THEN 'Unknown' WHEN age < 120 THEN 'Fresh' ELSE 'Stale' END AS freshness
FROM (SELECT event_id, event_type,
 CASE WHEN event_type = 'error' THEN 'never' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS last_update,
 epoch(date_trunc('second', (SELECT max(ts) FROM events)))::BIGINT - epoch(date_trunc('second', ts))::BIGINT AS age FROM events)""")
def kpi_freshness(v):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = F.when(F.col("event_type") == "error", "never").otherwise(iso)
    updates = v.events().select("event_id", text.alias("last_update"))
    return quality.kpi_freshness(updates, v.events_as_of)
