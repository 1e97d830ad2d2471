import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import data
from quaymaster.operators import accounting, running
from quaymaster.operators.running import floored_total, net_change, running_total
from quaymaster.session import scratch_path
from quaymaster.sinks.segments import SegmentTable
from quaymaster.sinks.warehouse import Warehouse

STATE = "sku_id string, dc_id string, on_hand_qty int, safety_stock int, reorder_point int, last_updated timestamp"


def state(spark, *rows):
    return spark.createDataFrame([(s, d, q, 5, 10, data.minutes_ago(60)) for s, d, q in rows], STATE)


def loop(stock, asked):
    """Orders served one after the other."""
    left, out = dict(stock), {}
    for order_id, sku, dc, _, units in sorted(asked, key=lambda o: (o[3], o[0])):
        filled = max(0, min(units, left.get((sku, dc), 0)))
        left[(sku, dc)] = left.get((sku, dc), 0) - filled
        out[order_id] = (filled, units - filled, units > filled)
    return out, left


@pytest.fixture
def sliced(spark):
    """Keep all slices, as a large run would."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_fulfilment_equals_the_loop_when_sliced(spark, sliced):
    check_fulfilment(spark, 1)


def test_fulfilment_equals_the_loop(spark):
    check_fulfilment(spark, 2)


def check_fulfilment(spark, seed):
    rng = random.Random(seed)
    pairs = [("hot", "D")] + [(f"s{i}", f"d{j}") for i in range(4) for j in range(3)]
    stock = {p: rng.randint(0, 400 if p[0] == "hot" else 60) for p in pairs if rng.random() < 0.9}
    asked = []
    for i in range(900):
        sku, dc = pairs[0] if rng.random() < 0.4 else rng.choice(pairs)
        asked.append((i, sku, dc, data.NOW + timedelta(minutes=rng.randint(0, 40)), rng.randint(1, 9)))
    orders = spark.createDataFrame(asked, "order_id bigint, sku_id string, dc_id string, order_ts timestamp, requested_qty int")
    opening = state(spark, *[(s, d, q) for (s, d), q in stock.items()])
    expected, left = loop(stock, asked)
    got = accounting.fulfil_orders(orders, opening).collect()
    assert {r["order_id"]: (r["fulfilled_qty"], r["lost_sales_qty"], r["lost_sale_flag"]) for r in got} == expected
    after = accounting.state_after_orders(opening, orders, data.NOW).collect()
    assert {(r["sku_id"], r["dc_id"]): r["on_hand_qty"] for r in after} == {p: left[p] for p in stock}


def test_running_total_spreads_a_hot_key(spark, sliced):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"),
        F.col("id").alias("at"), F.col("id").alias("units"),
    )
    out = running_total(df, ["key"], ["at"], "units", "before").collect()
    sums: dict = {}
    for row in sorted(out, key=lambda r: r["at"]):
        assert row["before"] == sums.get(row["key"], 0)
        sums[row["key"]] = sums.get(row["key"], 0) + row["units"]
    assert len(out) == 3000
    slices = df.repartitionByRange("key", "at").withColumn("slice", F.spark_partition_id()).where("key = 'hot'")
    assert slices.select("slice").distinct().count() > 1


def test_running_total_with_null_keys(spark, sliced):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 1, 7), (None, 3, 1)], "key string, at int, units int")
    got = {(r["key"], r["at"]): r["before"] for r in running_total(df, ["key"], ["at"], "units", "before").collect()}
    assert got == {(None, 1): 0, (None, 2): 5, (None, 3): 11, ("a", 1): 0}


def test_receiving_takes_due_open_shipments(spark, rows):
    sent = data.shipments(
        spark,
        {"shipment_id": "due", "sku_id": "S", "destination_dc_id": "D", "expected_arrival_ts": data.NOW, "quantity": 7},
        {"shipment_id": "later", "sku_id": "S", "destination_dc_id": "D", "expected_arrival_ts": data.NOW + timedelta(seconds=1)},
        {"shipment_id": "done", "sku_id": "S", "destination_dc_id": "D", "expected_arrival_ts": data.minutes_ago(9), "actual_arrival_ts": data.minutes_ago(5)},
        {"shipment_id": "lost", "sku_id": "X", "destination_dc_id": "D", "expected_arrival_ts": data.minutes_ago(9)},
    )
    after = accounting.receive_shipments(sent, state(spark, ("S", "D", 3), ("T", "D", 4)), data.NOW)
    assert sorted((r["sku_id"], r["on_hand_qty"], r["last_updated"]) for r in after.collect()) == [
        ("S", 10, data.NOW), ("T", 4, data.minutes_ago(60)),
    ]
    due = accounting.due_shipments(sent, data.NOW)
    assert sorted(r["shipment_id"] for r in due.collect()) == ["due", "lost"]
    assert [r["shipment_id"] for r in accounting.due_shipments(sent, data.NOW, 1).collect()] == ["lost"]
    assert {r["actual_arrival_ts"] for r in accounting.mark_received(due, data.NOW).collect()} == {data.NOW}


def test_balance_closes_at_opening_plus_received_minus_sold(spark):
    opening = state(spark, ("S", "D", 10))
    received = data.shipments(spark, {"shipment_id": "r", "sku_id": "S", "destination_dc_id": "D", "quantity": 4, "actual_arrival_ts": data.minutes_ago(5)})
    orders = spark.createDataFrame(
        [(1, "S", "D", data.minutes_ago(9), 6), (2, "S", "D", data.minutes_ago(5), 9), (3, "S", "D", data.minutes_ago(4), 1)],
        "order_id bigint, sku_id string, dc_id string, order_ts timestamp, requested_qty int",
    )
    moves = accounting.ledger(opening, orders, received)
    steps = accounting.inventory_balance(moves).orderBy("moved_ts", "step").collect()
    assert [(r["step"], r["units"], r["balance_before"], r["balance_after"]) for r in steps] == [
        (0, 10, 0, 10), (2, -6, 10, 4), (1, 4, 4, 8), (2, -8, 8, 0), (2, 0, 0, 0)]
    assert accounting.closing_balance(moves).first()["closing_qty"] == 0
    served = {r["order_id"]: (r["fulfilled_qty"], r["lost_sales_qty"], r["lost_sale_flag"]) for r in accounting.fulfilled_orders(moves).collect()}
    assert served == {1: (6, 0, False), 2: (8, 1, True), 3: (0, 1, True)}


def sent(spark, *rows):
    return data.shipments(spark, *[
        {"shipment_id": i, "sku_id": s, "destination_dc_id": "D", "quantity": q, "expected_arrival_ts": data.minutes_ago(m)} for i, s, q, m in rows])


def stocked(spark):
    return state(spark, ("S", "D", 3), ("T", "D", -4)).withColumn("on_hand_qty", F.col("on_hand_qty").cast("bigint"))


@pytest.fixture
def warehouse(spark):
    shipments = sent(spark, ("a", "S", 5, 20), ("b", "T", 6, 10), ("c", "S", 7, 0), ("d", "X", 1, 30))
    house = Warehouse(spark, scratch_path(spark, "warehouse"), shipments.schema, stocked(spark).schema)
    house.start(shipments, stocked(spark))
    return house


def seen(house):
    arrived = {r["shipment_id"]: r["actual_arrival_ts"] for r in house.shipments().collect()}
    return {r["sku_id"]: r["on_hand_qty"] for r in house.state().collect()}, {k for k, t in arrived.items() if t is not None}


def test_receiving_twice_receives_once(warehouse, spark):
    assert seen(warehouse) == ({"S": 3, "T": -4}, set())
    assert warehouse.receive(data.minutes_ago(10)) == 3
    assert seen(warehouse) == ({"S": 8, "T": 2}, {"a", "b", "d"})
    assert warehouse.receive(data.minutes_ago(10)) == 0
    warehouse.add_shipments(sent(spark, ("e", "S", 100, 5)))
    assert warehouse.receive(data.NOW, limit=1) == 1 and seen(warehouse) == ({"S": 108, "T": 2}, {"a", "b", "d", "e"})
    assert warehouse.receive(data.NOW) == 1 and seen(warehouse) == ({"S": 115, "T": 2}, {"a", "b", "c", "d", "e"})


@pytest.mark.parametrize("writes", [1, 2])
def test_receiving_that_fails_between_its_writes_changes_nothing(warehouse, monkeypatch, writes):
    """The run fails after one write, or after both and before the commit; its repeat gives what one run gives."""
    real, done = SegmentTable.write, []

    def write(self, *args, **more):
        if len(done) == writes:
            raise OSError("lost")
        done.append(1)
        return real(self, *args, **more)

    monkeypatch.setattr(SegmentTable, "write", write)
    if writes == 2:
        monkeypatch.setattr(SegmentTable, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        warehouse.receive(data.minutes_ago(10))
    monkeypatch.undo()
    assert seen(warehouse) == ({"S": 3, "T": -4}, set())
    assert warehouse.receive(data.minutes_ago(10)) == 3
    assert seen(warehouse) == ({"S": 8, "T": 2}, {"a", "b", "d"})


def test_many_runs_are_folded(warehouse, spark, monkeypatch):
    monkeypatch.setattr("quaymaster.sinks.warehouse.MOST_DELTAS", 2)
    for i in range(6):
        warehouse.add_shipments(sent(spark, (f"n{i}", "S", 1, 0)))
        warehouse.receive(data.NOW)
    assert seen(warehouse)[0] == {"S": 3 + 12 + 6, "T": 2} and len(seen(warehouse)[1]) == 10
    kinds = [s["kind"] for s in warehouse.table.segments(warehouse.table.newest())]
    assert kinds.count("arrivals") <= 2 and kinds.count("state") == 1


def sequential(stock, events):
    """Receipts and orders one after the other: fulfilled units by order, balances by movement, closing stock."""
    left = {p: max(0, q) for p, q in stock.items()}
    filled, steps = {}, []
    for when, step, number, pair, units in sorted(events, key=lambda e: e[:3]):
        before = left.get(pair, 0)
        moved = units if step == 1 else -max(0, min(units, before))
        left[pair] = before + moved
        steps.append((pair, step, number, moved, before, before + moved))
        if step == 2:
            filled[number] = -moved
    return filled, steps, left


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ledger_with_receipts_equals_the_loop(spark, sliced, seed):
    """Interleaved receipts and orders; one pair holds most of the rows and lies in many slices."""
    rng = random.Random(seed)
    pairs = [("hot", "D")] + [(f"s{i}", f"d{j}") for i in range(4) for j in range(3)] + [(None, "D"), ("only-received", "D")]
    stock = {p: rng.randint(-5, 60) for p in pairs[:-1] if p[0] and rng.random() < 0.9}
    events = []
    for i in range(1500):
        pair = pairs[0] if rng.random() < 0.6 else rng.choice(pairs)
        step = 1 if rng.random() < 0.3 or pair[0] == "only-received" else 2
        events.append((data.NOW + timedelta(minutes=rng.randint(0, 60)), step, i, pair, rng.randint(0, 30 if step == 1 else 15)))
    filled, steps, left = sequential(stock, events)
    orders = spark.createDataFrame(
        [(n, *p, when, u) for when, step, n, p, u in events if step == 2],
        "order_id bigint, sku_id string, dc_id string, order_ts timestamp, requested_qty int")
    received = data.shipments(spark, *[
        {"shipment_id": f"{n:05d}", "sku_id": p[0], "destination_dc_id": p[1], "quantity": u, "actual_arrival_ts": when}
        for when, step, n, p, u in events if step == 1])
    opening = state(spark, *[(s, d, q) for (s, d), q in stock.items()])
    moves = accounting.ledger(opening, orders, received).persist()
    got = {r["order_id"]: r["fulfilled_qty"] for r in accounting.fulfilled_orders(moves).collect()}
    assert got == filled
    seen = [((r["sku_id"], r["dc_id"]), r["step"], int(r["movement_id"]), r["units"], r["balance_before"], r["balance_after"])
            for r in accounting.inventory_balance(moves).where("step > 0").collect()]
    assert sorted(seen, key=repr) == sorted(steps, key=repr)
    closing = {(r["sku_id"], r["dc_id"]): r["closing_qty"] for r in accounting.closing_balance(moves).collect()}
    assert closing == {p: left.get(p, 0) for p in left | stock}
    moves.unpersist()


def test_floored_total_spreads_a_hot_key(spark, sliced):
    rng = random.Random(9)
    rows = [("hot" if i % 3 else f"k{i % 40}", i, rng.randint(-20, 18)) for i in range(4000)]
    df = spark.createDataFrame(rows, "key string, at int, units bigint")
    got = {r["at"]: (r["before"], r["after"]) for r in floored_total(df, ["key"], ["at"], "units", "before", "after").collect()}
    level: dict = {}
    for key, at, units in rows:
        before = level.get(key, 0)
        level[key] = max(0, before + units)
        assert got[at] == (before, level[key])
    assert df.repartitionByRange("key", "at").where("key = 'hot'").select(F.spark_partition_id()).distinct().count() > 1


def moved(spark, seed):
    """Rows of a hot key, of a hot null key and of small ones."""
    rng = random.Random(seed)
    rows = [((None if i % 3 == 1 else "hot") if i % 3 else f"k{i % 40}", i, rng.randint(-20, 18)) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "key string, at int, units bigint")


@pytest.mark.parametrize("buckets", [1, 1 << 16])
def test_hot_keys_are_sliced_and_the_others_are_not(spark, sliced, monkeypatch, buckets):
    monkeypatch.setattr(running, "HOT_ROWS", 100)
    monkeypatch.setattr(running, "BUCKETS", buckets)
    rows, df = moved(spark, 5)
    cold, hot = running.by_heat(df, ["key"])
    assert {r["key"] for r in hot.select("key").distinct().collect()} == {"hot", None}
    assert cold.count() + hot.count() == 3000 and cold.where("key is null or key = 'hot'").isEmpty()
    got = {r["at"]: (r["before"], r["after"]) for r in floored_total(df, ["key"], ["at"], "units", "before", "after").collect()}
    level: dict = {}
    for key, at, units in rows:
        before = level.get(key, 0)
        level[key] = max(0, before + units)
        assert got[at] == (before, level[key])


def test_keys_of_a_full_bucket_need_not_be_hot(spark, monkeypatch):
    monkeypatch.setattr(running, "HOT_ROWS", 100)
    monkeypatch.setattr(running, "BUCKETS", 1)
    assert running.by_heat(spark.range(300).select((F.col("id") % 20).alias("key")), ["key"])[1] is None


@pytest.mark.parametrize("most", [100, 10_000])
def test_net_change_equals_the_loop(spark, sliced, monkeypatch, most):
    monkeypatch.setattr(running, "HOT_ROWS", most)
    rows, df = moved(spark, 6)
    sums: dict = {}
    for key, _, units in rows:
        total, least = sums.get(key, (0, None))
        sums[key] = (total + units, total + units if least is None else min(least, total + units))
    assert {r["key"]: (r["total"], r["least"]) for r in net_change(df, ["key"], ["at"], "units").collect()} == sums


def test_small_keys_are_moved_by_one_exchange(spark):
    _, df = moved(spark, 7)
    plan = floored_total(df, ["key"], ["at"], "units", "before", "after")._jdf.queryExecution().toString()
    assert plan.partition("== Physical Plan ==")[2].count("Exchange") == 1 and "Join" not in plan


def test_reorder_at_the_reorder_point(spark, rows):
    skus = data.skus(spark, {"sku_id": "S", "demand_base_lambda": 10}, {"sku_id": "T", "demand_base_lambda": 1})
    low = accounting.reorder_candidates(state(spark, ("S", "D", 10), ("T", "D", 9), ("S", "E", 11), ("X", "D", 0)), skus)
    assert sorted(rows(low)) == [("S", "D", 10, 10, 210), ("T", "D", 9, 10, 50)]


def test_policy_of_known_pairs(spark, rows):
    skus = data.skus(spark, {"sku_id": "S"}, {"sku_id": "T", "demand_base_lambda": 40, "stock_coverage_days": 30})
    pairs = [("S", "D"), ("S", "E"), ("T", "D")], "sku_id string, dc_id string"
    known = accounting.known_pairs(spark.createDataFrame(*pairs), spark.createDataFrame([("T", "E"), ("S", "D")], pairs[1]))
    policy = accounting.stock_policy(known, skus, 2.0)
    assert sorted(rows(policy)) == [
        ("S", "D", 100, 70, 90, 5), ("S", "E", 100, 70, 90, 5), ("T", "D", 2400, 280, 360, 30), ("T", "E", 2400, 280, 360, 30),
    ]
    first = accounting.initial_state(policy, data.NOW).where("sku_id = 'T' and dc_id = 'D'").first()
    assert (first["on_hand_qty"], first["base_stock"], first["last_updated"]) == (2400, 2400, data.NOW)


def test_weights_and_shares(spark):
    weights = accounting.supplier_weights(
        data.suppliers(spark, {"supplier_id": "a", "reliability_score": 0.6}, {"supplier_id": "b", "reliability_score": 0.8})
    )
    assert {r["supplier_id"]: round(r["weight"], 9) for r in weights.collect()} == {"a": 0.36, "b": 0.64}
    share = accounting.sku_event_share(data.skus(spark, {"sku_id": "S", "demand_base_lambda": 1}, {"sku_id": "T", "demand_base_lambda": 3}))
    assert {r["sku_id"]: r["demand_share"] for r in share.collect()} == {"S": 0.25, "T": 0.75}


def test_expected_arrival(spark):
    row = spark.range(1).select(accounting.expected_arrival(F.lit(data.NOW), F.lit(1.5)).alias("days")).first()
    assert row["days"] == data.NOW + timedelta(hours=36)


def test_snapshot_has_a_stable_id_per_pair(spark):
    one = accounting.snapshot(state(spark, ("S", "D", 1), ("T", "D", 2)), data.NOW)
    two = accounting.snapshot(state(spark, ("S", "D", 1), ("T", "D", 2)), data.NOW)
    assert one.exceptAll(two).count() == 0 and one.select("inventory_event_id").distinct().count() == 2
