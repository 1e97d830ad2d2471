"""Streaming queries, run over everything available now and compared on closed windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaymaster.functions.scalars import moment
from quaymaster.operators.quality import Rule, fails, range_rule
from quaymaster.plans.kpi_run import kpis_from, publish
from quaymaster.plans.q_kpis import (
    AVG_STOCK, LEVEL, PERFORMANCE, REGIONAL, RISK, USAGE, WI, WO, WS, cover_of, dimensions, window_inventory, window_orders,
    window_shipments,
)
from quaymaster.plans.q_sources import EVENTS
from quaymaster.plans.registry import DAYS, EVENTS_AS_OF, MINUTES, query, rounded
from quaymaster.plans.sql import LINE_HASH, with_views
from quaymaster.session import materialise, scratch_path
from quaymaster.sinks import serving
from quaymaster.sinks.archive import archive_folder, compact, read_archive
from quaymaster.sinks.compaction import file_sizes, merges
from quaymaster.sources.retail_views import RetailViews, line_id
from quaymaster.sources.tables import Period, scan_stream
from quaymaster.streaming import pipelines
from quaymaster.streaming.partials import PartialSums, demand_partial, lead_time_partial, stock_partial
from quaymaster.streaming.state_log import StateLog

LONG = "100 days"  # lateness of a stream whose batches hold rows of all times
CLOSED = f"{EVENTS_AS_OF} - INTERVAL 2 MINUTE"


def event_stream(v: RetailViews):
    return scan_stream(v.spark, EVENTS, v.folder, pathGlobFilter="events.parquet")


def landed(v: RetailViews, stream, label: str):
    """The rows that a stream has appended to a folder."""
    path = scratch_path(v.spark, label)
    pipelines.to_files(stream, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    return v.spark.read.schema(stream.schema).parquet(f"{path}/data")


def _windows(df):
    out = rounded(df, 2, "total_value")
    return out.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")}
    )


@query("stream_ingest", "A9", "SELECT event_id, user_id, event_type, value, props FROM events")
def stream_ingest(v):
    return landed(v, event_stream(v).drop("ts"), "ingest")


@query("stream_sliding_kpis", "S1 S3", f"""
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(w + INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
 event_type, count(*) AS event_count, round(sum(value), 2) AS total_value
FROM (SELECT *, date_trunc('minute', ts) - to_minutes(i) AS w FROM events, range(15) r(i))
WHERE w + INTERVAL 15 MINUTE <= {CLOSED} GROUP BY w, event_type""")
def stream_sliding_kpis(v):
    stream = pipelines.sliding_kpis(event_stream(v), "ts", ["event_type"], "value")
    return _windows(landed(v, stream, "sliding"))


@query("stream_tumbling_volumes", "S2 S3", f"""
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(w + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
 event_type, count(*) AS event_count, round(sum(value), 2) AS total_value
FROM (SELECT *, date_trunc('minute', ts) AS w FROM events) WHERE w + INTERVAL 1 MINUTE <= {CLOSED} GROUP BY w, event_type""")
def stream_tumbling_volumes(v):
    stream = pipelines.tumbling_volumes(event_stream(v), "ts", ["event_type"], "value")
    return _windows(landed(v, stream, "tumbling"))


@query("stream_deduplicated", "S4 S3", "SELECT event_id, user_id, event_type, value FROM events")
def stream_deduplicated(v):
    """Every event arrives twice."""
    twice = event_stream(v).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    stream = pipelines.deduplicated(twice, "ts", "event_id").select("event_id", "user_id", "event_type", "value")
    return landed(v, stream, "dedup")


@query("stream_enriched", "S6", """
SELECT event_id, event_type, c_nationkey AS dc_id, n_name AS dc_name
FROM events LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def stream_enriched(v):
    customers = v.table("customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("dc_id"))
    joined = pipelines.enriched(event_stream(v), customers, "user_id")
    joined = pipelines.enriched(joined, v.dcs().select("dc_id", "dc_name"), "dc_id")
    return landed(v, joined.select("event_id", "event_type", "dc_id", "dc_name"), "enriched")


PARTS = 3  # micro-batches of the queries that run several


@query("stream_published_kpis", "S5 B3", with_views("orders_fact inventory_fact shipments_fact suppliers skus dcs regions", """
SELECT region_id, region_name, total_orders, total_units_fulfilled, revenue, (SELECT count(*) FROM levels) AS levels,
 (SELECT count(*) FROM risk) AS alerts, (SELECT count(*) FROM scored) AS suppliers, (SELECT count(*) FROM usage) AS centers
FROM regional""", wo=WO, wi=WI, ws=WS, levels=LEVEL.format(stock=AVG_STOCK, source="wi"), cover=cover_of(), risk=RISK,
    scored=PERFORMANCE.format(source="ws"), usage=USAGE.format(source="wi"), regional=REGIONAL.format(source="wo")))
def stream_published_kpis(v):
    """The facts arrive in several micro-batches. Each is reduced to partial sums; each batch of orders publishes
    all five KPIs from the sums of the window as a new version."""
    path = scratch_path(v.spark, "published")
    served, orders_from, stock_from = f"{path}/serving", Period(v.orders_as_of, MINUTES).start, Period(v.inventory_as_of, MINUTES).start
    arriving = {
        "shipments": (window_shipments(v), lead_time_partial(), orders_from, "shipment_id"),
        "inventory": (window_inventory(v), stock_partial(), stock_from, "inventory_event_id"),
        "orders": (window_orders(v), demand_partial(), orders_from, "order_line_id"),
    }
    dealt = {name: materialise(rows, f"arriving-{name}") for name, (rows, *_) in arriving.items()}
    sums = {name: PartialSums(v.spark, f"{path}/sums/{name}", partial, dealt[name].schema) for name, (_, partial, _, _) in arriving.items()}

    def publish_kpis(version):
        leads, stock, demand = (sums[name].rollup(arriving[name][2]) for name in arriving)
        result = kpis_from(stock, demand, leads, dimensions(v), float(DAYS))
        serving.write_serving(publish(result, Period(v.orders_as_of, MINUTES)), served, version)

    for part in range(PARTS):
        for name, (_, _, start, event_id) in arriving.items():
            dealt[name].where(F.pmod(F.xxhash64(event_id), F.lit(PARTS)) == part).write.mode("append").parquet(f"{path}/source/{name}")
            stream = scan_stream(v.spark, dealt[name].schema, f"{path}/source/{name}")
            pipelines.keep_partials(
                stream, sums[name], start, f"{path}/checkpoint/{name}", publish_kpis if name == "orders" else None).awaitTermination()
    table = serving.read_serving(v.spark, served)
    schema = "region_id int, region_name string, total_orders bigint, total_units_fulfilled bigint, revenue double"
    count = lambda key: table.where(F.col("kpi_key") == key).agg(F.count("*")).scalar()
    return serving.read_records(table, serving.REGIONAL_KEY, schema, v.orders_as_of).drop("position").withColumns({
        "levels": count(serving.INVENTORY_KEY), "alerts": count(serving.STOCKOUT_KEY),
        "suppliers": count(serving.SUPPLIER_KEY), "centers": count(serving.UTILIZATION_KEY)})


@query("stream_archive", "S8 H1", """
SELECT strftime(ts, '%Y-%m-%d') AS event_date, hour(ts)::INT AS event_hour, count(*) AS events, round(sum(value), 2) AS total_value
FROM events GROUP BY ALL""")
def stream_archive(v):
    """Every event arrives twice and is archived once."""
    path = scratch_path(v.spark, "stream-archive")
    twice = event_stream(v).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    pipelines.to_archive(twice, "ts", "event_id", f"{path}/events", f"{path}/checkpoint").awaitTermination()
    rows = read_archive(v.spark, f"{path}/events", [f for f in EVENTS.fields if f.name != "ts"])
    out = rows.groupBy(F.col("event_date").cast("string").alias("event_date"), "event_hour").agg(
        F.count("*").alias("events"), F.sum("value").alias("total_value")
    )
    return rounded(out, 2, "total_value")


@query("stream_archive_compacted", "S8 B1", """
SELECT strftime(ts, '%Y-%m-%d') AS event_date, hour(ts)::INT AS event_hour, count(*) AS events, round(sum(value), 2) AS total_value,
 true AS fewer_files FROM events GROUP BY ALL""")
def stream_archive_compacted(v):
    """Events are archived by several micro-batches, whose small files are then merged; readers see every row once."""
    path = scratch_path(v.spark, "stream-archive")
    events, columns = v.events(), [f for f in EVENTS.fields if f.name != "ts"]
    for part in range(PARTS):
        events.where(F.pmod("event_id", F.lit(PARTS)) == part).write.mode("append").parquet(f"{path}/source")
    arriving = scan_stream(v.spark, EVENTS, f"{path}/source", maxFilesPerTrigger="1")
    pipelines.to_archive(arriving, "ts", "event_id", f"{path}/events", f"{path}/checkpoint", LONG, spread=1).awaitTermination()
    base = f"{path}/events"
    files = lambda: file_sizes(archive_folder(v.spark, base, columns)).agg(F.count("*")).first()[0]
    before = files()
    replaced = compact(v.spark, base, columns, "event_id")
    merged = file_sizes(merges(v.spark, base).read(merges(v.spark, base).segments(0), read_archive(v.spark, base, columns).schema)).agg(F.count("*")).first()[0]
    rows = read_archive(v.spark, base, columns)
    out = rows.groupBy(F.col("event_date").cast("string").alias("event_date"), "event_hour").agg(
        F.count("*").alias("events"), F.sum("value").alias("total_value"))
    return rounded(out, 2, "total_value").withColumn("fewer_files", F.lit(before - replaced + merged < before))


def event_rules() -> list[Rule]:
    return [
        Rule("value_not_negative", F.col("value") < 0), range_rule("value_range", "value", 10, 90),
        Rule("user_known", fails(F.col("user_id").isNotNull())),
    ]


@query("stream_rule_report", "Q11 S8", """
SELECT 'events' AS table_name, rule, checked, violations FROM (
 SELECT 'value_not_negative' AS rule, count(*) AS checked, count(*) FILTER (value < 0) AS violations FROM events
 UNION ALL SELECT 'value_range', count(*), count(*) FILTER (value NOT BETWEEN 10 AND 90) FROM events
 UNION ALL SELECT 'user_known', count(*), count(*) FILTER (user_id IS NULL) FROM events)""")
def stream_rule_report(v):
    """Violations among the rows that a stream has written in several micro-batches, counted by the pass that writes them."""
    path = scratch_path(v.spark, "checked")
    rules = event_rules()
    for part in range(PARTS):
        v.events().where(F.pmod("event_id", F.lit(PARTS)) == part).coalesce(1).write.mode("append").parquet(f"{path}/source")
    stream = pipelines.checked(scan_stream(v.spark, EVENTS, f"{path}/source", maxFilesPerTrigger="1"), rules)
    run = pipelines.to_files(stream.select("event_id", "value"), f"{path}/data", f"{path}/checkpoint")
    run.awaitTermination()
    return pipelines.stream_rule_report(run, "events", rules)


@query("stream_inventory_state", "S7 B7 I1 I2", with_views("inventory_state", """
SELECT sku_id, dc_id, (on_hand_qty + coalesce(total + greatest(0, -(on_hand_qty + least_total)), 0))::BIGINT AS on_hand_qty
FROM inventory_state
LEFT JOIN (SELECT sku_id, dc_id, sum(units) AS total, min(run) AS least_total FROM
 (SELECT *, sum(units) OVER (PARTITION BY sku_id, dc_id ORDER BY l_shipdate, h ROWS UNBOUNDED PRECEDING) AS run FROM
  (SELECT l_partkey AS sku_id, s_nationkey AS dc_id, l_shipdate, """ + LINE_HASH + """ AS h,
   CASE WHEN l_linestatus = 'F' THEN l_quantity::BIGINT ELSE -l_quantity::BIGINT END AS units
   FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)) GROUP BY ALL) m USING (sku_id, dc_id)"""))
def stream_inventory_state(v):
    """Order lines as a stream in several micro-batches, by ship date: finished ones are receipts, open ones
    orders, at the supplier's center."""
    first, last = v.table("lineitem").agg(F.min("l_shipdate"), F.max("l_shipdate")).first()
    cuts = [first + (last - first) * i / PARTS for i in range(1, PARTS)] + [None]
    lines = v.table("lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", "l_linestatus", "l_shipdate", line_id().alias("line_id"))
    centers = v.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("dc_id"))
    initial = v.inventory_state().withColumn("on_hand_qty", F.col("on_hand_qty").cast("bigint"))
    path, start = scratch_path(v.spark, "state"), None
    log = StateLog(v.spark, f"{path}/state", initial.schema)
    log.start(initial)
    shipped = F.col("l_shipdate")
    for end in cuts:
        since = F.lit(True) if start is None else shipped >= moment(start, "timestamp_ntz")
        until = F.lit(True) if end is None else shipped < moment(end, "timestamp_ntz")
        lines.where(since & until).write.mode("append").parquet(f"{path}/source")
        start = end
        moves = pipelines.enriched(scan_stream(v.spark, lines.schema, f"{path}/source"), centers, "l_suppkey").select(
            F.when(F.col("l_linestatus") == "F", "receipt").otherwise("order").alias("kind"), F.col("l_partkey").alias("sku_id"),
            "dc_id", F.col("l_quantity").cast("bigint").alias("units"), "l_shipdate", "line_id")
        pipelines.run_state(moves, log, ["l_shipdate", "line_id"], f"{path}/checkpoint", v.inventory_as_of).awaitTermination()
    return log.read().select("sku_id", "dc_id", "on_hand_qty")
