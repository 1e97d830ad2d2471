import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import data
from quaymaster.operators import kpis
from quaymaster.session import scratch_path
from quaymaster.sinks.segments import SegmentTable
from quaymaster.sources.tables import scan_stream
from quaymaster.streaming import partials, pipelines, state_log
from quaymaster.streaming.partials import PartialSums, demand_partial, lead_time_partial, stock_partial
from quaymaster.streaming.state_log import StateLog, apply_moves

EVENTS = "event_id bigint, kind string, value double, at timestamp"


def drop(spark, path, *rows):
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, schema=EVENTS, **options):
    return scan_stream(spark, spark.createDataFrame([], schema).schema, path, **options)


def landed(spark, df, base):
    pipelines.to_files(df, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def test_rolling_window_equals_batch_on_closed_windows(spark):
    base = scratch_path(spark, "stream")
    events = [(i, "ab"[i % 2], float(i), data.NOW + timedelta(seconds=37 * i)) for i in range(120)]
    drop(spark, f"{base}/in", *events)
    got = landed(spark, pipelines.sliding_kpis(stream(spark, f"{base}/in"), "at", ["kind"], "value"), base)
    closed = events[-1][3] - timedelta(minutes=2)
    batch = (
        spark.createDataFrame(events, EVENTS).groupBy(F.window("at", "15 minutes", "1 minute"), "kind")
        .agg(F.count("*").alias("event_count"), F.sum("value").alias("total_value"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "kind", "event_count", "total_value")
        .where(F.col("window_end") <= F.lit(closed))
    )
    assert batch.count() > 100
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_late_rows_are_left_out(spark):
    base = scratch_path(spark, "stream")
    drop(spark, f"{base}/in", (1, "a", 1.0, data.NOW), (2, "a", 1.0, data.NOW + timedelta(minutes=10)))
    df = pipelines.tumbling_volumes(stream(spark, f"{base}/in"), "at", ["kind"], "value")
    assert landed(spark, df, base).count() == 1
    drop(spark, f"{base}/in", (3, "a", 1.0, data.NOW), (4, "a", 1.0, data.NOW + timedelta(minutes=20)))
    got = landed(spark, df, base).orderBy("window_start").collect()
    assert [(r["window_start"], r["event_count"]) for r in got] == [(data.NOW, 1), (data.NOW + timedelta(minutes=10), 1)]


def test_copies_across_batches_are_dropped(spark):
    base = scratch_path(spark, "stream")
    drop(spark, f"{base}/in", (1, "a", 1.0, data.NOW), (1, "a", 1.0, data.NOW))
    df = pipelines.deduplicated(stream(spark, f"{base}/in"), "at", "event_id")
    landed(spark, df, base)
    drop(spark, f"{base}/in", (1, "a", 1.0, data.NOW), (2, "a", 1.0, data.NOW))
    assert sorted(r["event_id"] for r in landed(spark, df, base).collect()) == [1, 2]


def test_stream_archive_layout(spark):
    base = scratch_path(spark, "stream")
    drop(spark, f"{base}/in", (1, "a", 1.0, data.NOW), (2, "a", 1.0, data.NOW - timedelta(hours=13)))
    drop(spark, f"{base}/in", (1, "a", 1.0, data.NOW))
    pipelines.to_archive(stream(spark, f"{base}/in"), "at", "event_id", f"{base}/cold", f"{base}/checkpoint").awaitTermination()
    got = spark.read.parquet(f"{base}/cold").select("event_id", F.col("event_date").cast("string"), "event_hour", "event_day")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "2025-03-01", 12, 1), (2, "2025-02-28", 23, 28)]


MOVES = "kind string, sku_id string, dc_id string, units bigint, at int"
STATE = "sku_id string, dc_id string, on_hand_qty bigint, last_updated timestamp"


def level(df):
    return sorted((r["sku_id"], r["on_hand_qty"]) for r in df.collect())


def opening(spark, n=2):
    return spark.createDataFrame([(f"S{i}", "D", 10 - i, data.minutes_ago(9)) for i in range(n)], STATE)


def test_state_runs_over_batches_and_restarts(spark):
    base = scratch_path(spark, "state")
    state = opening(spark)
    log = StateLog(spark, f"{base}/state", state.schema)
    log.start(state)
    batches = (
        [("receipt", "S0", "D", 5, 2), ("order", "S0", "D", 12, 1)],
        [("order", "S0", "D", 20, 3), ("receipt", "S1", "D", 1, 4), ("receipt", "S0", "D", 2, 5), ("order", "unknown", "D", 2, 6)],
    )
    for units in batches:
        spark.createDataFrame(units, MOVES).coalesce(1).write.mode("append").parquet(f"{base}/in")
        pipelines.run_state(stream(spark, f"{base}/in", MOVES), log, ["at"], f"{base}/checkpoint", data.NOW).awaitTermination()
    levels = [level(log.read(v)) for v in (1, 2)]
    assert levels == [[("S0", 5), ("S1", 9)], [("S0", 2), ("S1", 10)]]
    whole = spark.createDataFrame([m for b in batches for m in b], MOVES)
    assert level(apply_moves(state, whole, ["at"], data.NOW)) == levels[1]
    assert log.table.versions() == [1, 2]


def sequential(stock, moves):
    left = dict(stock)
    for kind, sku, _, units, _ in sorted(moves, key=lambda m: m[4]):
        if sku in left:
            left[sku] = left[sku] + units if kind == "receipt" else max(0, left[sku] - units)
    return sorted(left.items())


def test_log_follows_the_loop_through_deltas_merges_and_folds(spark, monkeypatch):
    monkeypatch.setattr(state_log, "MOST_DELTAS", 2)
    rng = random.Random(4)
    state = opening(spark, 60)
    log = StateLog(spark, scratch_path(spark, "log"), state.schema)
    log.start(state)
    stock, done, kinds = {f"S{i}": 10 - i for i in range(60)}, [], []
    stock = {k: max(q, 0) for k, q in stock.items()}
    log.start(state.withColumn("on_hand_qty", F.greatest(F.lit(0), "on_hand_qty")))
    for n in range(9):
        batch = [(rng.choice(["receipt", "order"]), f"S{rng.randint(0, 25 if n > 6 else 4)}", "D", rng.randint(0, 9), 100 * n + i) for i in range(30)]
        log.append(spark.createDataFrame(batch, MOVES), n, ["at"], data.NOW)
        done += batch
        assert level(log.read()) == sorted(sequential(stock, done))
        segments = log.table.segments(n + 1)
        kinds.append([s["kind"] for s in segments])
        # What a version adds is no larger than what its batch touches, until deltas make up half of the base.
        if len([s for s in segments if s["kind"] == "delta"]):
            assert segments[-1]["rows"] <= 26 and segments[0]["rows"] == 60 and segments[0]["name"].startswith("v000000000000")
    assert kinds[:3] == [["base", "delta"], ["base", "delta", "delta"], ["base", "delta"]] and ["base"] in kinds


def test_repeated_batch_gives_the_same_state(spark):
    state = opening(spark, 4)
    log = StateLog(spark, scratch_path(spark, "log"), state.schema)
    log.start(state)
    batch = spark.createDataFrame([("order", "S1", "D", 4, 1), ("receipt", "S2", "D", 3, 2)], MOVES)
    log.append(batch, 0, ["at"], data.NOW)
    first = level(log.read())
    lost = log.table.write(state_log.change_of(batch, ["at"], 2, data.NOW, state.schema["last_updated"].dataType), 2, kind="delta")
    assert level(log.read()) == first  # written but not published
    log.append(batch, 0, ["at"], data.NOW)
    assert level(log.read()) == first == [("S0", 10), ("S1", 5), ("S2", 11), ("S3", 7)]
    log.append(batch, 1, ["at"], data.NOW)
    assert level(log.read()) == [("S0", 10), ("S1", 1), ("S2", 14), ("S3", 7)]
    names = {f.getPath().getName() for f in log.table._files().listStatus(log.table._path(f"{log.base}/segments"))}
    assert not any(lost["name"] in name for name in names)


# Partial sums ----------------------------------------------------------------------------------


def sold(n, minutes, seed):
    rng = random.Random(seed)
    return [{"order_id": f"{seed}-{i}", "sku_id": f"s{rng.randint(0, 3)}", "dc_id": f"d{rng.randint(0, 1)}", "quantity": rng.randint(1, 9),
             "order_value": float(rng.randint(1, 99)), "order_ts": data.NOW + timedelta(minutes=minutes, seconds=rng.randint(-100, 59))} for i in range(n)]


def test_window_of_partial_sums_equals_the_window_of_rows(spark, monkeypatch):
    monkeypatch.setattr(partials, "MOST_SEGMENTS", 3)
    rows, sums, reads = [], None, []
    for n in range(9):
        new = sold(40, 2 * n, n)
        rows += new
        batch = data.orders(spark, *new)
        sums = sums or PartialSums(spark, scratch_path(spark, "sums"), demand_partial(), batch.schema)
        start = data.NOW + timedelta(minutes=max(0, 2 * n - 6))
        sums.add(batch, n, start)
        want = kpis.demand_rollup(data.orders(spark, *[r for r in rows if r["order_ts"] >= start]))
        got = sums.rollup(start).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        reads.append(sum(s["rows"] for s in sums.table.segments(n + 1)))
    # At most a row for each of eight pairs, minute of the window and segment, however many batches there have been.
    assert max(reads) <= 8 * 10 * 3 and max(reads[5:]) <= 1.5 * max(reads[:5])
    sums.add(data.orders(spark, *new), 8, start)  # the last batch once more
    again = sums.rollup(start).select(*want.columns)
    assert again.exceptAll(want).count() == 0 and want.exceptAll(again).count() == 0


def test_stock_and_lead_time_sums_equal_the_roll_ups(spark):
    rng = random.Random(2)
    stock = data.inventory(spark, *[
        {"inventory_event_id": str(i), "sku_id": f"s{i % 3}", "dc_id": "d", "on_hand_qty": rng.randint(0, 50), "safety_stock": rng.randint(0, 9),
         "inventory_ts": data.minutes_ago(rng.randint(0, 14))} for i in range(60)])
    sent = data.shipments(spark, *[
        {"shipment_id": str(i), "supplier_id": f"p{min(i, 3)}", "lead_time_days": None if i == 9 else rng.randint(1, 90) / 8,
         "shipment_ts": data.minutes_ago(rng.randint(0, 14))} for i in range(40)])
    start = data.minutes_ago(15)
    for rows, partial, want, key in (
        (stock, stock_partial(), kpis.inventory_rollup(stock), "sku_id"), (sent, lead_time_partial(), kpis.lead_times(sent), "supplier_id"),
    ):
        sums = PartialSums(spark, scratch_path(spark, "sums"), partial, rows.schema)
        for n in range(3):
            sums.add(rows.where(F.pmod(F.xxhash64(rows.columns[0]), F.lit(3)) == n), n, start)
        got = {r[key]: r for r in sums.rollup(start).collect()}
        for r in want.collect():
            for name in want.columns:
                assert got[r[key]][name] == (pytest.approx(r[name]) if isinstance(r[name], float) else r[name]), name


def test_published_lists_are_seen_whole(spark):
    table = SegmentTable(spark, scratch_path(spark, "segments"))
    assert table.newest() is None and table.versions() == []
    one = table.write(spark.range(3), 0, kind="a")
    two = table.write(spark.range(5), 1)
    assert table.newest() is None  # written, not published
    table.publish(0, [one])
    table.publish(1, [one, two])
    table.publish(1, [two])
    assert table.newest() == 1 and table.segments(1) == [two] and two["rows"] == 5
    assert table.read(table.segments(0), spark.range(1).schema).count() == 3
    table.publish(2, [])
    table.clean(keep=2)
    assert table.versions() == [1, 2] and table.read([], spark.range(1).schema).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(table.segment_path(one))


def test_published_batches_carry_their_id(spark):
    base, seen = scratch_path(spark, "publish"), []
    for i in range(2):
        drop(spark, f"{base}/in", (i, "a", 1.0, data.NOW))
        pipelines.publish_each_batch(
            stream(spark, f"{base}/in"), lambda df, n: seen.append((n, df.count())), f"{base}/checkpoint"
        ).awaitTermination()
    assert seen == [(0, 1), (1, 1)]


def test_static_enrichment(spark):
    base = scratch_path(spark, "stream")
    drop(spark, f"{base}/in", (1, "a", 1.0, data.NOW), (2, "z", 1.0, data.NOW))
    names = spark.createDataFrame([("a", "Alpha")], "kind string, name string")
    got = landed(spark, pipelines.enriched(stream(spark, f"{base}/in"), names, "kind"), base)
    assert sorted((r["event_id"], r["name"]) for r in got.collect()) == [(1, "Alpha"), (2, None)]
