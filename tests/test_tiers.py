from datetime import timedelta

import pytest
from pyspark.sql import functions as F, types as T

import data
from quaymaster import schemas
from quaymaster.operators import membership, setops
from quaymaster.operators.quality import Rule, breaks_any, broken_rules
from quaymaster.operators.setops import one_of_each
from quaymaster.session import materialise, scratch_path
from quaymaster.sinks import archive, serving
from quaymaster.sinks.archive import ArchiveTable
from quaymaster.sinks.compaction import file_sizes, plan
from quaymaster.sinks.hot import HotTable
from quaymaster.sinks.segments import SegmentTable
from quaymaster.sinks.sketches import read_sketches, sketch_path, write_sketches
from quaymaster.streaming import pipelines
from quaymaster.sources.tables import replace_table, scan_archive

CUTOFF = archive.cutoff_of(data.NOW)


def sold(spark, ages):
    return data.orders(spark, *[{"order_id": f"o{a}", "sku_id": "S", "order_ts": data.minutes_ago(a)} for a in ages])


def table(rows, closed=None):
    return ArchiveTable("orders_fact", rows, "order_ts", "order_id", closed)


def ids(df):
    return sorted(r["order_id"] for r in df.select("order_id").collect())


def test_archive_is_idempotent_and_excludes_the_cutoff(spark):
    base = scratch_path(spark, "t")
    first = archive.append_new(table(sold(spark, [1, 120, 121, 200, 2000])), base, CUTOFF)
    assert first["record_count"] == 3 and first["size_mb"] == 0.0
    assert first["date_range"] == {"min": "2025-02-28T02:40:00.000000", "max": "2025-03-01T09:59:00.000000"}
    assert archive.append_new(table(sold(spark, [1, 120, 121, 200, 2000])), base, CUTOFF) is None
    more = archive.append_new(table(sold(spark, [121, 130, 200])), base, CUTOFF)
    assert more["record_count"] == 1
    cold = scan_archive(spark, base, "orders_fact")
    assert ids(cold) == ["o121", "o130", "o200", "o2000"]
    row = cold.where("order_id = 'o2000'").first()
    assert (str(row["event_date"]), row["event_hour"], row["event_year"], row["event_month"], row["event_day"]) == ("2025-02-28", 2, 2025, 2, 28)


def test_archive_scan_prunes_partitions(spark, capsys):
    base = scratch_path(spark, "t")
    archive.append_new(table(sold(spark, [121, 200, 2000])), base, CUTOFF)
    picked = scan_archive(spark, base, "orders_fact", data.minutes_ago(1000), data.minutes_ago(150))
    assert ids(picked) == ["o200"]
    capsys.readouterr()
    picked.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(event_date" in plan and "PushedFilters: [IsNotNull(order_ts)" in plan


def test_hot_and_cold_hold_every_row_once(spark):
    base, rows = scratch_path(spark, "t"), sold(spark, [1, 120, 121, 2000])
    archive.append_new(table(rows), base, CUTOFF)
    cold = scan_archive(spark, base, "orders_fact")
    kept = archive.retained(table(rows), base, CUTOFF)
    assert ids(kept) == ["o1", "o120"]
    assert ids(setops.unify(kept, cold, "order_id", "order_ts", CUTOFF)) == ids(rows)
    assert ids(setops.unify(rows, cold, "order_id", "order_ts", CUTOFF)) == ids(rows)
    assert ids(setops.unify(rows, cold, "order_id", "order_ts")) == ids(rows)


def dated(spark, ids_of, hour="2025-02-27 05:00:00"):
    return spark.createDataFrame([(f"id-{i}", "2025-02-27", 5) for i in ids_of], "order_id string, event_date string, event_hour int").withColumn(
        "event_date", F.col("event_date").cast("date"))


def test_sketches_miss_no_id_and_rule_out_nearly_all_others(spark):
    path = scratch_path(spark, "t")
    for part in (range(0, 3000), range(3000, 3100)):
        write_sketches(dated(spark, part), "order_id", path)
    sketches = read_sketches(spark, path)
    assert sketches.parts.count() == 2 and sketches.blocks.count() < 3100 * 10 / 512 + 3
    held = membership.maybe_held(dated(spark, range(3100)), "order_id", sketches)
    assert held.select("order_id").distinct().count() == 3100
    others = membership.maybe_held(dated(spark, range(10_000, 20_000)), "order_id", sketches).select("order_id").distinct().count()
    assert others < 500
    elsewhere = dated(spark, range(3100)).withColumn("event_hour", F.lit(6))
    assert membership.maybe_held(elsewhere, "order_id", sketches).count() == 0


def test_late_rows_are_looked_up_and_archived_rows_stay_where_they_are(spark):
    base, rows = scratch_path(spark, "t"), sold(spark, [1, 120, 121, 125, 300, 2000])
    archive.append_new(table(sold(spark, [121, 300, 2000])), base, CUTOFF)
    path = f"{base}/orders_fact"
    cold, sketches = scan_archive(spark, base, "orders_fact"), read_sketches(spark, path)
    both = setops.unify(rows, cold, "order_id", "order_ts", CUTOFF, sketches)
    assert ids(both) == ids(rows)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Exchange hashpartitioning" not in plan and "Aggregate" not in plan
    # Sketches of rows that never came cost a lookup and no row.
    write_sketches(archive.with_date_parts(sold(spark, [120, 125]), "order_ts"), "order_id", path)
    assert ids(setops.unify(rows, cold, "order_id", "order_ts", CUTOFF, read_sketches(spark, path))) == ids(rows)
    assert ids(archive.retained(table(rows), base, CUTOFF)) == ["o1", "o120", "o125"]


def test_archive_without_sketches_stays_exact(spark):
    base = scratch_path(spark, "t")
    archive.append_new(table(sold(spark, [121, 300])), base, CUTOFF)
    folder = spark._jvm.org.apache.hadoop.fs.Path(sketch_path(f"{base}/orders_fact"))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    assert archive.append_new(table(sold(spark, [121, 130, 300])), base, CUTOFF)["record_count"] == 1
    assert read_sketches(spark, f"{base}/orders_fact") is None
    assert ids(archive.retained(table(sold(spark, [5, 121, 130, 140])), base, CUTOFF)) == ["o140", "o5"]


def test_stream_does_not_append_to_a_sketched_archive(spark):
    base = scratch_path(spark, "t")
    archive.append_new(table(sold(spark, [121])), base, CUTOFF)
    with pytest.raises(ValueError, match="sketches"):
        pipelines.to_archive(sold(spark, [500]), "order_ts", "order_id", f"{base}/orders_fact", scratch_path(spark, "c"))


def test_hot_scan_opens_only_files_of_its_time(spark):
    schema = schemas.ORDERS_FACT
    hot = HotTable(spark, scratch_path(spark, "hot"), schema, "order_ts")
    assert hot.scan().count() == 0 and hot.files() == []
    hot.append(sold(spark, range(1, 200)), files=10)
    hot.append(sold(spark, [5, 500]).unionByName(data.orders(spark, {"order_id": "timeless", "order_ts": None})))
    every = sorted([f"o{a}" for a in range(1, 200)] + ["o5", "o500", "timeless"])
    assert ids(hot.scan()) == every
    recent_rows = hot.scan(data.minutes_ago(15))
    assert ids(recent_rows) == sorted([f"o{a}" for a in range(1, 16)] + ["o5"])
    assert len(recent_rows.inputFiles()) < len(hot.files()) / 2
    assert ids(hot.scan(data.minutes_ago(20), data.minutes_ago(10))) == [f"o{a}" for a in range(11, 21)]
    assert ids(hot.scan(data.NOW + timedelta(days=1))) == []
    gone = hot.retire(data.minutes_ago(100))
    assert gone > 0 and set(ids(hot.scan())) >= {f"o{a}" for a in range(1, 101)} | {"o5", "timeless"}
    assert len(hot.files()) + gone >= 11 and hot.retire(data.minutes_ago(100)) == 0


def test_busy_partitions_are_split_and_ids_archived_once(spark, monkeypatch):
    monkeypatch.setattr(archive, "FILE_ROWS", 1)
    base = scratch_path(spark, "t")
    rows = sold(spark, [1, 121, 200, 2000])
    stats = archive.append_new(table(rows.unionByName(rows)), base, CUTOFF)
    assert stats["record_count"] == 3
    assert stats["date_range"] == {"min": "2025-02-28T02:40:00.000000", "max": "2025-03-01T09:59:00.000000"}
    assert ids(scan_archive(spark, base, "orders_fact")) == ["o121", "o200", "o2000"]


def test_late_row_is_not_deleted_before_it_is_archived(spark):
    base = scratch_path(spark, "t")
    archive.append_new(table(sold(spark, [121])), base, CUTOFF)
    late = sold(spark, [1, 121, 125])
    assert ids(archive.retained(table(late), base, CUTOFF)) == ["o1", "o125"]


def test_open_shipments_stay_hot(spark):
    rows = data.shipments(
        spark,
        {"shipment_id": "open", "shipment_ts": data.minutes_ago(500)},
        {"shipment_id": "closed", "shipment_ts": data.minutes_ago(500), "actual_arrival_ts": data.minutes_ago(300)},
    )
    shipments = ArchiveTable("shipments_fact", rows, "shipment_ts", "shipment_id", F.col("actual_arrival_ts").isNotNull())
    base = scratch_path(spark, "t")
    assert archive.append_new(shipments, base, CUTOFF)["record_count"] == 1
    assert [r["shipment_id"] for r in archive.retained(shipments, base, CUTOFF).collect()] == ["open"]


def test_run_skips_empty_and_goes_on_after_a_failure(spark):
    base, kept = scratch_path(spark, "t"), {}
    broken = ArchiveTable("broken", sold(spark, [300]), "no_such_column", "order_id")
    empty = ArchiveTable("shipments_fact", data.shipments(spark), "shipment_ts", "shipment_id")
    stats, errors = archive.run_archive(
        spark, [broken, empty, table(sold(spark, [5, 300, 400]))], base, data.NOW,
        keep=lambda name, rows: kept.update({name: sorted(r[0] for r in rows.select(rows.columns[0]).collect())}),
    )
    assert [(r["collection"], r["record_count"]) for r in stats.collect()] == [("orders_fact", 2)]
    assert set(errors) == {"broken"} and kept == {"broken": ["o300"], "shipments_fact": [], "orders_fact": ["o5"]}
    again: dict = {}
    archive.run_archive(spark, [table(sold(spark, [5, 300, 400]))], base, data.NOW, keep=lambda n, rows: again.update({n: ids(rows)}))
    assert again == {"orders_fact": ["o5"]}
    entry = spark.read.json(f"{base}/metadata").first()
    assert entry["total_records"] == 2 and entry["archive_policy"]["older_than_minutes"] == 120
    assert entry["archived_collections"][0]["collection"] == "orders_fact" and len(entry["archive_id"]) == 36


def test_run_without_due_rows_writes_nothing(spark):
    base = scratch_path(spark, "t")
    stats, errors = archive.run_archive(spark, [table(sold(spark, [5]))], base, data.NOW)
    assert stats.count() == 0 and errors == {}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.json(f"{base}/metadata")


def data_files(spark, base):
    rows = archive.archive_folder(spark, f"{base}/orders_fact", schemas.ORDERS_FACT.fields)
    return {r["file"] for r in file_sizes(rows).collect()}


def test_compaction_swaps_files_for_readers(spark):
    base = scratch_path(spark, "t")
    path, columns = f"{base}/orders_fact", schemas.ORDERS_FACT.fields
    for ages in ([121, 2000], [130, 131], [140, 3000]):
        archive.append_new(table(sold(spark, ages)), base, CUTOFF)
    every = ["o121", "o130", "o131", "o140", "o2000", "o3000"]
    small = data_files(spark, base)
    early = scan_archive(spark, base, "orders_fact")  # a reader that has listed the old files
    assert archive.compact(spark, path, columns, "order_id") == 3  # the hour that three runs have written
    assert ids(scan_archive(spark, base, "orders_fact")) == every == ids(early) == ids(archive.read_archive(spark, path, columns))
    assert ids(scan_archive(spark, base, "orders_fact", data.minutes_ago(200))) == ["o121", "o130", "o131", "o140"]
    opened = {r[0] for r in archive.read_archive(spark, path, columns).select(F.input_file_name()).distinct().collect()}
    assert len(opened) == 3  # one merged file and the two hours of one file
    # Later rows of a merged hour are read beside it, and merged by the next run.
    archive.append_new(table(sold(spark, [121, 150, 151])), base, CUTOFF)
    archive.append_new(table(sold(spark, [152])), base, CUTOFF)
    every = sorted([*every, "o150", "o151", "o152"])
    assert ids(scan_archive(spark, base, "orders_fact")) == every
    assert archive.compact(spark, path, columns, "order_id") == 2 and archive.compact(spark, path, columns, "order_id") == 0
    assert ids(scan_archive(spark, base, "orders_fact")) == every
    assert archive.expire_replaced(spark, path, columns) == 5 and archive.expire_replaced(spark, path, columns) == 0
    assert len(data_files(spark, base)) == 2 and len(small & data_files(spark, base)) == 2
    assert ids(scan_archive(spark, base, "orders_fact")) == every
    assert ids(archive.retained(table(sold(spark, [1, 121, 150, 160])), base, CUTOFF)) == ["o1", "o160"]


def test_compaction_that_is_not_published_changes_nothing(spark, monkeypatch):
    base = scratch_path(spark, "t")
    path, columns = f"{base}/orders_fact", schemas.ORDERS_FACT.fields
    for ages in ([121], [130]):
        archive.append_new(table(sold(spark, ages)), base, CUTOFF)
    monkeypatch.setattr(SegmentTable, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        archive.compact(spark, path, columns, "order_id")
    monkeypatch.undo()
    assert ids(scan_archive(spark, base, "orders_fact")) == ["o121", "o130"]
    assert archive.compact(spark, path, columns, "order_id") == 2
    assert ids(scan_archive(spark, base, "orders_fact")) == ["o121", "o130"]
    assert archive.compact(spark, f"{base}/nothing", columns, "order_id") == 0


def test_plan_takes_many_small_files_only(spark):
    rows = [("2025-01-01", 1, f"a{i}", 10) for i in range(5)] + [("2025-01-01", 2, "b", 5)] + [("2025-01-01", 3, f"c{i}", 100) for i in range(2)]
    files = spark.createDataFrame(rows, "event_date string, event_hour int, file string, bytes bigint")
    assert [(r["event_hour"], r["merged"], sorted(r["names"])) for r in plan(files, 40).collect()] == [(1, 2, [f"a{i}" for i in range(5)])]


def test_serving_records_expire_and_parse(spark):
    kpi = spark.createDataFrame([("a", 3.0), ("b", None), ("c", 9.0)], "name string, score double")
    served = serving.serving_table(
        [
            serving.metadata(spark, data.NOW, 15),
            serving.records(kpi, "kpi:top", [F.desc("score"), "name"], data.NOW, limit=2),
            serving.records(kpi, "kpi:all", [], data.NOW),
            serving.counter(kpi.agg(F.count("*")), "kpi:n", data.NOW),
        ]
    )
    path = scratch_path(spark, "serving")
    for version in (1, 2, 3):
        serving.write_serving(served, path, version)
    table = serving.read_serving(spark, path)
    top = serving.read_records(table, "kpi:top", "name string, score double", data.NOW).orderBy("position").collect()
    assert [tuple(r) for r in top] == [(1, "c", 9.0), (2, "a", 3.0)]
    assert serving.read_records(table, "kpi:all", "name string, score double", data.NOW).count() == 3
    assert serving.read_records(table, "kpi:all", "name string", data.NOW + timedelta(seconds=120)).count() == 0
    values = {r["kpi_key"]: r["value"] for r in serving.read_values(table, ["kpi:n", "kpi:last_update", "kpi:analysis_window_minutes"], data.NOW).collect()}
    assert values == {"kpi:n": "3", "kpi:last_update": "2025-03-01T12:00:00", "kpi:analysis_window_minutes": "15"}


def test_replaced_table_has_the_new_rows_only(spark):
    path = scratch_path(spark, "dims")
    for n in (3, 2):
        replace_table(spark.range(n).select(F.col("id").cast("string").alias("region_id")), path, T.StructType([T.StructField("region_id", T.StringType())]))
    assert spark.read.parquet(path).count() == 2


def test_tasks_of_an_archive_run_follow_its_rows(spark, monkeypatch):
    monkeypatch.setattr(archive, "TASK_ROWS", 10)
    day = F.lit("2025-03-01").cast("date").alias("event_date")
    due = spark.range(300).select(
        F.col("id").alias("event_id"), F.col("id").cast("string").alias("text"), day, F.pmod("id", F.lit(24)).cast("int").alias("event_hour"))
    counts = due.groupBy("event_date", "event_hour").agg(F.count("*").alias("ids"))
    path = scratch_path(spark, "spread")
    archive.spread(materialise(due, "due"), "event_id", materialise(counts, "counts")).write.parquet(path)
    out = spark.read.parquet(path)
    assert out.count() == 300 and len(out.inputFiles()) > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_an_append_in_parts_is_the_same(spark, monkeypatch):
    """All rows were shuffled at once, beside the due rows and the archive; with a part for each row some parts are empty."""
    rows, found = sold(spark, [1, *range(121, 129), 200, 2000]), []
    for at_once in (archive.SLICE_ROWS, 3, 1):
        monkeypatch.setattr(archive, "SLICE_ROWS", at_once)
        base = scratch_path(spark, "t")
        rules = (Rule("far", F.col("order_ts") < F.lit(data.minutes_ago(1000))),)
        fact = ArchiveTable("orders_fact", rows.unionByName(rows), "order_ts", "order_id", None, rules)
        stats = archive.append_new(fact, base, CUTOFF)
        cold = scan_archive(spark, base, "orders_fact")
        found.append((stats, ids(cold), len(cold.inputFiles())))
        assert archive.append_new(fact, base, CUTOFF) is None
    assert found[0] == found[1] == found[2]
    assert found[0][0]["record_count"] == len(found[0][1]) == 10 and found[0][0]["measures"] == {"checked": 10, "far": 1}


def test_an_append_that_failed_between_parts_is_made_up_for(spark, monkeypatch):
    monkeypatch.setattr(archive, "SLICE_ROWS", 1)
    whole, ages = archive.spread, [1, 121, 200, 500, 900, 1500, 2000]

    def broken(due, event_id, counts, part=0, parts=1):
        if part == parts - 2:
            raise OSError("disk")
        return whole(due, event_id, counts, part, parts)

    base = scratch_path(spark, "t")
    monkeypatch.setattr(archive, "spread", broken)
    with pytest.raises(OSError):
        archive.append_new(table(sold(spark, ages)), base, CUTOFF)
    monkeypatch.setattr(archive, "spread", whole)
    assert ids(archive.retained(table(sold(spark, ages)), base, CUTOFF)) > ["o1"]
    archive.append_new(table(sold(spark, ages)), base, CUTOFF)
    assert ids(scan_archive(spark, base, "orders_fact")) == sorted(f"o{a}" for a in ages[1:])


def test_an_append_leaves_its_archive_only(spark):
    import glob

    from quaymaster import session

    base = scratch_path(spark, "t")
    archive.append_new(table(sold(spark, [121, 200])), base, CUTOFF)
    before = set(glob.glob(f"{session.run_root(spark).removeprefix('file:')}/**/*", recursive=True))
    archive.append_new(table(sold(spark, [1, 121, 130, 2000])), base, CUTOFF)
    after = set(glob.glob(f"{session.run_root(spark).removeprefix('file:')}/**/*", recursive=True)) - before
    assert after and all(f.startswith(base.removeprefix("file:")) for f in after)
    assert spark.conf.get(session.SHUFFLE_CLEANUP, "false") == "false"


@pytest.mark.parametrize("late", [None, False, True])
def test_broken_rows_have_each_id_once(spark, late):
    rules = [Rule("late", F.col("late")), Rule("small", F.col("n") < 2)]
    rows = spark.createDataFrame([(1, late, 1), (1, late, 1), (None, late, 1), (None, late, 1), (3, late, 5)], "id int, late boolean, n int")
    broken = one_of_each(rows.where(breaks_any(rules)).withColumn("names", broken_rules(rules)), ["id"])
    names = ["late", "small"] if late else ["small"]
    expected = [(None, names), (1, names)] + ([(3, ["late"])] if late else [])
    assert sorted([(r["id"], r["names"]) for r in broken.collect()], key=str) == sorted(expected, key=str)


def test_archived_ids_are_sorted_once_and_not_aggregated(spark):
    due = spark.range(30).select(
        F.col("id").alias("event_id"), F.col("id").cast("string").alias("text"), F.lit("2025-03-01").cast("date").alias("event_date"),
        F.lit(1).alias("event_hour"))
    counts = materialise(due.groupBy("event_date", "event_hour").agg(F.count("*").alias("ids")), "counts")
    plan = archive.spread(materialise(due, "due"), "event_id", counts)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count(" Sort ") == 1


def test_partitions_follow_the_input(spark):
    from quaymaster import session

    names = [session.INITIAL_PARTITIONS, session.SPLIT_SETTING]
    before = [spark.conf.get(n, None) for n in names]
    try:
        session.size_tasks(spark, 1 << 30)
        assert spark.range(10).repartitionByRange("id").rdd.getNumPartitions() <= 256 == int(spark.conf.get(names[0]))
        session.size_tasks(spark, 1)
        assert spark.conf.get(names[0]) == "256"
        assert spark.conf.get(names[1]) == session.SPLIT_BYTES
    finally:
        for name, value in zip(names, before):
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_a_written_table_leaves_no_shuffle_setting(spark):
    from quaymaster import session

    out = session.materialise(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert out.count() == 7 and spark.conf.get(session.SHUFFLE_CLEANUP, "false") == "false"
    assert all(f.endswith(".zstd.parquet") for f in out.inputFiles())
