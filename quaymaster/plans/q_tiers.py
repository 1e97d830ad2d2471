"""Archive, retention, serving table and seeded tables: queries that write and read back."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from quaymaster import schemas
from quaymaster.operators import setops
from quaymaster.plans.kpi_run import publish
from quaymaster.plans.q_kpis import (
    DIMS, LEVEL, AVG_STOCK, PERFORMANCE, REGIONAL, RISK, USAGE, WI, WO, WS, cover_of, kpi_set,
)
from quaymaster.plans.registry import EVENTS_AS_OF, MINUTES, query, rounded
from quaymaster.plans.sql import with_views
from quaymaster.session import scratch_path
from quaymaster.sinks import archive, serving
from quaymaster.sinks.archive import ArchiveTable
from quaymaster.sinks.hot import HotTable
from quaymaster.sinks.sketches import read_sketches
from quaymaster.sources.retail_views import RetailViews
from quaymaster.sources.tables import Period, scan_archive

CUTOFF = f"{EVENTS_AS_OF} - INTERVAL 120 MINUTE"


def event_table(v: RetailViews) -> ArchiveTable:
    return ArchiveTable("events", v.events(), "ts", "event_id")


def archived_events(v: RetailViews, runs: int = 1):
    """Path of an archive of the events older than two hours, and its cutoff."""
    base, cutoff = scratch_path(v.spark, "archive"), archive.cutoff_of(v.events_as_of)
    for _ in range(runs):
        archive.append_new(event_table(v), base, cutoff)
    return base, cutoff


# Archive ---------------------------------------------------------------------------


@query("archive_append", "B1 A3 H1", f"""
SELECT strftime(ts, '%Y-%m-%d') AS event_date, hour(ts)::INT AS event_hour, count(*) AS events,
 round(sum(value), 2) AS total_value, min(event_id) AS first_id, max(event_id) AS last_id
FROM events WHERE ts < {CUTOFF} GROUP BY ALL""")
def archive_append(v):
    """Two runs with the same cutoff: the second one adds nothing."""
    base, _ = archived_events(v, runs=2)
    rows = archive.read_archive(v.spark, f"{base}/events", v.events().schema.fields)
    return rounded(
        rows.groupBy(F.col("event_date").cast("string").alias("event_date"), "event_hour").agg(
            F.count("*").alias("events"), F.sum("value").alias("total_value"), F.min("event_id").alias("first_id"),
            F.max("event_id").alias("last_id"),
        ), 2, "total_value",
    )


@query("archive_scan", "A5", f"""
SELECT event_id, user_id, event_type, value, year(ts)::INT AS event_year, month(ts)::INT AS event_month, day(ts)::INT AS event_day
FROM events WHERE ts < {CUTOFF} AND ts >= {EVENTS_AS_OF} - INTERVAL 20 DAY""")
def archive_scan(v):
    """Archive rows from a time on: pruned by date, exact by event time."""
    base, cutoff = archived_events(v)
    start = v.events_as_of - timedelta(days=20)
    picked = scan_archive(v.spark, base, "events", start, schema=v.events().schema, ts="ts")
    return picked.select("event_id", "user_id", "event_type", "value", "event_year", "event_month", "event_day")


@query("hot_period_scan", "A2 A5", f"""
SELECT event_id, user_id, event_type, value, true AS files_skipped FROM events WHERE ts >= {EVENTS_AS_OF} - INTERVAL 2 DAY""")
def hot_period_scan(v):
    """The last two days from a hot table that got its rows in several appends: files of other times are not opened."""
    events = v.events()
    hot = HotTable(v.spark, scratch_path(v.spark, "hot"), events.schema, "ts")
    for part in range(2):  # a small table would be one file, so the number is given
        hot.append(events.where(F.pmod("event_id", F.lit(2)) == part), files=16)
    start = v.events_as_of - timedelta(days=2)
    rows = hot.scan(start)
    skipped = len(rows.inputFiles()) < len(hot.files())
    return rows.select("event_id", "user_id", "event_type", "value", F.lit(skipped).alias("files_skipped"))


@query("retained_rows", "B6", f"SELECT event_id, event_type, value FROM events WHERE ts >= {CUTOFF}")
def retained_rows(v):
    base, cutoff = archived_events(v)
    return archive.retained(event_table(v), base, cutoff).select("event_id", "event_type", "value")


@query("hot_cold_after_archive", "G1 B1 B6 A5", "SELECT event_id, user_id, event_type, value FROM events")
def hot_cold_after_archive(v):
    """Hot and cold after archiving and deleting hold what was hot before, each row once."""
    base, cutoff = archived_events(v)
    hot = archive.retained(event_table(v), base, cutoff)
    cold = archive.read_archive(v.spark, f"{base}/events", v.events().schema.fields)
    sketches = read_sketches(v.spark, f"{base}/events")
    return setops.unify(hot, cold, "event_id", "ts", cutoff, sketches).select("event_id", "user_id", "event_type", "value")


FACT_COUNTS = """
SELECT '{t}' AS collection, count(*) AS record_count, round(count(*) * 500 / 1048576.0, 2)::DOUBLE AS size_mb,
 strftime(min({ts}), '%Y-%m-%dT%H:%M:%S.%f') AS first_ts, strftime(max({ts}), '%Y-%m-%dT%H:%M:%S.%f') AS last_ts
FROM {t} WHERE {ts} < (SELECT max(o_orderdate) FROM orders) - INTERVAL 120 MINUTE"""


def fact_tables(v: RetailViews) -> list[ArchiveTable]:
    return [
        ArchiveTable("orders_fact", v.orders_fact(), "order_ts", "order_line_id"),
        ArchiveTable(
            "shipments_fact", v.shipments_fact(), "shipment_ts", "shipment_id", F.col("actual_arrival_ts").isNotNull()
        ),
        ArchiveTable("inventory_fact", v.inventory_fact(), "inventory_ts", "inventory_event_id"),
    ]


@query("archive_run", "B8 B1 E7 E8 E15", with_views(
    "orders_fact shipments_fact inventory_fact",
    "\nUNION ALL\n".join(FACT_COUNTS.format(t=t, ts=ts) for t, ts in schemas.FACT_TIME.items())))
def archive_run(v):
    stats, errors = archive.run_archive(v.spark, fact_tables(v), scratch_path(v.spark, "archive"), v.orders_as_of)
    if errors:
        raise RuntimeError(str(errors))
    return stats.select(
        "collection", "record_count", "size_mb", F.col("date_range.min").alias("first_ts"), F.col("date_range.max").alias("last_ts")
    )


@query("archive_manifest", "B2 E15 E16", f"""
SELECT 1::INT AS archived_tables, count(*)::BIGINT AS total_records, round(count(*) * 500 / 1048576.0, 2)::DOUBLE AS total_size_mb,
 120 AS older_than_minutes, 'parquet' AS format, 'snappy' AS compression, 'event_date,event_hour' AS partitioned_by
FROM events WHERE ts < {CUTOFF}""")
def archive_manifest(v):
    base = scratch_path(v.spark, "archive")
    archive.run_archive(v.spark, [event_table(v)], base, v.events_as_of)
    written = v.spark.read.schema(
        "archived_collections array<struct<collection:string,record_count:bigint,size_mb:double>>, total_records bigint, "
        "total_size_mb double, archive_policy struct<older_than_minutes:int,format:string,compression:string,"
        "partitioned_by:array<string>>"
    ).json(f"{base}/metadata")
    return written.select(
        F.size("archived_collections").alias("archived_tables"), "total_records", "total_size_mb",
        "archive_policy.older_than_minutes", "archive_policy.format", "archive_policy.compression",
        F.array_join("archive_policy.partitioned_by", ",").alias("partitioned_by"),
    )


# Serving table ------------------------------------------------------------------------


def published(v: RetailViews, **tops: int):
    """The serving table of a KPI run, written and read back."""
    result = kpi_set(v, keep=True)
    path = scratch_path(v.spark, "serving")
    serving.write_serving(publish(result, Period(v.orders_as_of, MINUTES), **tops), path, serving.version_of(v.orders_as_of))
    result.release()
    return serving.read_serving(v.spark, path)


LEVEL_CTE = LEVEL.format(stock=AVG_STOCK, source="wi")
SERVED = dict(
    wi=WI, wo=WO, ws=WS, levels=LEVEL_CTE, cover=cover_of(), risk=RISK, usage=USAGE.format(source="wi"),
    scored=PERFORMANCE.format(source="ws"), regional=REGIONAL.format(source="wo"),
)
SERVED_VIEWS = f"inventory_fact orders_fact shipments_fact suppliers {DIMS}"


@query("serving_record_counts", "B3 B4 B5 Q17", with_views(SERVED_VIEWS, """
SELECT k AS kpi_key, n::BIGINT AS "records", 120::BIGINT AS ttl_seconds FROM (
 SELECT 'kpi:inventory_level' AS k, (SELECT count(*) FROM levels) AS n
 UNION ALL SELECT 'kpi:stockout_alerts', (SELECT count(*) FROM risk)
 UNION ALL SELECT 'kpi:supplier_performance', (SELECT count(*) FROM scored)
 UNION ALL SELECT 'kpi:dc_utilization', (SELECT count(*) FROM usage)
 UNION ALL SELECT 'kpi:regional_performance', (SELECT count(*) FROM regional)
 UNION ALL SELECT 'kpi:stockout_risk_count', 1 UNION ALL SELECT 'kpi:dc_overloaded_count', 1
 UNION ALL SELECT 'kpi:last_update', 1 UNION ALL SELECT 'kpi:analysis_window_minutes', 1)""", **SERVED))
def serving_record_counts(v):
    age = F.unix_timestamp(F.max("expires_at")) - F.unix_timestamp(F.max("updated_at"))
    return published(v).groupBy("kpi_key").agg(F.count("*").alias("records"), age.alias("ttl_seconds"))


@query("serving_inventory", "B3 A6 G3 H6", with_views(SERVED_VIEWS, """
SELECT row_number() OVER (ORDER BY current_inventory DESC, sku_id, dc_id) AS position, *
FROM (SELECT * FROM levels ORDER BY current_inventory DESC, sku_id, dc_id LIMIT 100)""", **SERVED))
def serving_inventory(v):
    schema = (
        "sku_id bigint, product_name string, category string, dc_id int, dc_name string, current_inventory int, "
        "safety_stock_level int"
    )
    return serving.read_records(published(v, top_levels=100), serving.INVENTORY_KEY, schema, v.orders_as_of)


@query("serving_regional", "B3 A6 H6", with_views(SERVED_VIEWS, """
SELECT region_id, region_name, total_orders, total_units_fulfilled, revenue FROM regional""", **SERVED))
def serving_regional(v):
    schema = "region_id int, region_name string, total_orders bigint, total_units_fulfilled bigint, revenue double"
    return serving.read_records(published(v), serving.REGIONAL_KEY, schema, v.orders_as_of).drop("position")


@query("serving_counters", "B4 A6 H6 H7", with_views(SERVED_VIEWS, f"""
SELECT 'kpi:stockout_risk_count' AS kpi_key, count(*)::VARCHAR AS value FROM risk
UNION ALL SELECT 'kpi:dc_overloaded_count', (count(*) FILTER (utilization_rate >= 0.85))::VARCHAR FROM usage
UNION ALL SELECT 'kpi:analysis_window_minutes', '{MINUTES}'
UNION ALL SELECT 'kpi:last_update', strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S') FROM orders""", **SERVED))
def serving_counters(v):
    keys = [serving.STOCKOUT_COUNT_KEY, serving.OVERLOADED_COUNT_KEY, serving.WINDOW_KEY, serving.LAST_UPDATE_KEY]
    return serving.read_values(published(v), keys, v.orders_as_of)


@query("serving_expired", "B5 A6", with_views(
    SERVED_VIEWS, "SELECT (count(*) + (SELECT count(*) FROM levels))::BIGINT AS live_before, 0::BIGINT AS live_after FROM usage",
    **SERVED))
def serving_expired(v):
    """Records are live until two minutes after the run and gone from then on."""
    table = published(v).where(F.col("kpi_key").isin(serving.UTILIZATION_KEY, serving.INVENTORY_KEY))
    last, gone = (v.orders_as_of + timedelta(seconds=s) for s in (119, 120))
    after = serving.live(table, gone).agg(F.count("*")).scalar()
    return serving.live(table, last).agg(F.count("*").alias("live_before")).select("live_before", after.alias("live_after"))


@query("serving_document", "B3 A6 H6", with_views(SERVED_VIEWS, """
SELECT 'kpi:inventory_level' AS kpi_key, count(*) AS "records", sum(current_inventory)::BIGINT AS units,
 first(sku_id ORDER BY current_inventory DESC, sku_id, dc_id) AS first_sku FROM levels""", **SERVED))
def serving_document(v):
    """All records of a KPI, parsed and added up where they are."""
    parsed = serving.read_records(
        published(v), serving.INVENTORY_KEY, "sku_id bigint, dc_id int, current_inventory bigint", v.orders_as_of)
    first = F.min(F.struct(-F.col("current_inventory"), "sku_id", "dc_id"))["sku_id"]
    return parsed.agg(F.count("*").alias("records"), F.sum("current_inventory").alias("units"), first.alias("first_sku")).select(
        F.lit(serving.INVENTORY_KEY).alias("kpi_key"), "records", "units", "first_sku")


@query("kpi_availability", "Q17", with_views(SERVED_VIEWS, """
SELECT ((SELECT count(*) > 0 FROM levels)::INT + (SELECT count(*) > 0 FROM scored)::INT + (SELECT count(*) > 0 FROM usage)::INT)::BIGINT
 AS available_kpis, (SELECT count(*) FROM levels) + (SELECT count(*) FROM scored) + (SELECT count(*) FROM usage) > 0 AS has_data""",
    **SERVED))
def kpi_availability(v):
    from quaymaster.operators.quality import kpi_availability as available

    return available(published(v), [serving.INVENTORY_KEY, serving.SUPPLIER_KEY, serving.UTILIZATION_KEY])
