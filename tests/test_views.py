import data
from pyspark.sql import functions as F
from quaymaster.functions import bands, scalars
from quaymaster.operators import kpis, views


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_synonyms_defaults_and_fallbacks(spark):
    raw = spark.createDataFrame([("S", "D", "7", None), ("T", "E", "bad", "Tea")], "sku_id string, dc_id string, tte string, product_name string")
    out = {r["sku_id"]: r for r in views.normalize_stockout(raw).collect()}
    assert (out["S"]["days_to_stockout"], out["S"]["severity"]) == (7.0, "low")
    assert (out["T"]["days_to_stockout"], out["T"]["product_name"]) == (999.0, "Tea")
    assert out["S"]["product_name"] == "S" and out["S"]["dc_name"] == "D"


def test_preferred_synonym_wins(spark):
    raw = spark.createDataFrame([(1, 2, 3)], "quantity int, on_hand_qty int, reorder_point int")
    row = views.normalize_inventory(raw).first()
    assert (row["current_inventory"], row["safety_stock_level"]) == (2.0, 3.0)
    bare = views.normalize_suppliers(spark.createDataFrame([("x",)], "supplier_id string")).first()
    assert (bare["avg_lead_time_days"], bare["reliability_score"], bare["performance_score"]) == (0.0, 0.0, 0.0)


def test_rescale_is_opt_in(spark):
    raw = spark.createDataFrame([("a", 85.0), ("b", 0.5)], "dc_id string, utilization double")
    plain = [r["utilization_rate"] for r in views.normalize_utilization(raw).orderBy("dc_id").collect()]
    scaled = [r["utilization_rate"] for r in views.normalize_utilization(raw, rescale=True).orderBy("dc_id").collect()]
    assert plain == [85.0, 0.5] and scaled == [0.85, 0.005]
    small = raw.where("dc_id = 'b'")
    assert views.normalize_utilization(small, rescale=True).first()["utilization_rate"] == 0.5


def test_available_columns_skips_absent_ones(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert views.available_columns(df, ["b", "c"]).columns == ["b"]


def test_severity_edges(spark):
    days = spark.createDataFrame([(0.99,), (1.0,), (3.0,), (7.0,), (None,)], "d double")
    got = days.select(bands.alert_severity(F.col("d")), bands.alert_band(F.col("d")), bands.stockout_severity(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [
        ("critical", "CRITICAL", "Critical"), ("high", "HIGH", "Critical"), ("medium", "WARNING", "Critical"),
        ("low", "LOW", "Warning"), ("low", "LOW", "Normal"),
    ]


def test_dashboard_bands_are_strict(spark):
    pct = spark.createDataFrame([(85.0,), (85.1,), (75.0,), (75.1,)], "p double")
    assert [r[0] for r in pct.select(bands.dc_badge(F.col("p"))).collect()] == ["High", "Critical", "Normal", "High"]
    assert [r[0] for r in pct.select(bands.traffic_light(F.col("p"), 85, 75)).collect()] == ["warning", "danger", "success", "warning"]
    score = spark.createDataFrame([(0.9,), (0.8,), (0.7,), (0.69,), (None,)], "s double")
    assert [r[0] for r in score.select(bands.supplier_grade(F.col("s"))).collect()] == ["A", "B", "C", "D", "D"]


def test_hour_and_value_bands(spark):
    hours = spark.createDataFrame([(8,), (9,), (17,), (18,), (22,), (23,)], "h int")
    assert [r[0] for r in hours.select(bands.hour_demand_factor(F.col("h"))).collect()] == [0.7, 1.5, 1.5, 1.2, 1.2, 0.7]
    values = spark.createDataFrame([(1000.0,), (1000.1,), (5000.0,), (5000.1,)], "v double")
    assert [r[0] for r in values.select(bands.order_value_band(F.col("v"))).collect()] == ["low", "medium", "medium", "high"]


def test_number_formats(spark):
    row = one(
        spark, m=scalars.compact_number(F.lit(2500000.0)), k=scalars.compact_number(F.lit(1500.0)),
        n=scalars.compact_number(F.lit(999.0)), t=scalars.thousands(F.lit(1234567.0)), p=scalars.percent_text(F.lit(85.04)),
        small=scalars.money_card(F.lit(999999.0)), big=scalars.money_card(F.lit(2500000.0)),
    )
    assert tuple(row) == ("2.50M", "1.5K", "999", "1,234,567", "85.0%", "$1000.0K", "$2.50M")


def test_ratio_time_and_ids(spark):
    row = one(
        spark, r=scalars.ratio(F.lit(1), F.lit(0)), z=scalars.display_time(F.lit("2025-01-02T03:04:05.678Z")),
        o=scalars.display_time(F.lit("2025-01-02T03:04:05+02:00")), bad=scalars.display_time(F.lit("soon")),
        i=scalars.is_uuid(scalars.stable_id(F.lit("a"), F.lit(1))), n=scalars.is_uuid(F.lit("a-b")),
        size=scalars.size_mb(F.lit(1_000_000)), cut=scalars.whole(F.lit(-2.9)), num=scalars.to_number(F.lit("x"), 5),
        age=scalars.age_seconds(F.lit(data.minutes_ago(2)), F.lit(data.NOW)),
    )
    assert tuple(row) == (None, "2025-01-02 03:04:05", "2025-01-02 01:04:05", None, True, False, 476.84, -2, 5.0, 120)


def test_executive_totals_of_empty_kpis(spark):
    inv = data.inventory(spark)
    skus, dcs, regions = data.skus(spark), data.dcs(spark), data.regions(spark)
    totals = views.executive_totals(
        kpis.inventory_level(inv, skus, dcs), kpis.stockout_risk(inv, data.orders(spark), skus, dcs, regions, 1.0),
        kpis.supplier_performance(data.shipments(spark), data.suppliers(spark)), kpis.dc_utilization(inv, skus, dcs),
        kpis.regional_performance(data.orders(spark), dcs, regions),
    )
    assert tuple(totals.first()) == (0, 0, 0.0, 0.0, 0.0)
    cards = views.executive_cards(totals).first()
    assert tuple(cards) == ("0", "0", "success", "0.0", "0.0%", "success", "$0.0K")


def test_heatmap_and_top(spark, rows):
    inv = spark.createDataFrame(
        [("a", "X", 3), ("a", "Y", 4), ("b", "X", 9), ("a", "X", 1)], "product_name string, dc_name string, current_inventory int"
    )
    assert sorted(rows(views.inventory_heatmap(inv, ["X", "Y"]))) == [("a", 4, 4), ("b", 9, 0)]
    assert rows(views.top_skus(inv, 1)) == [("b", 9)]
    assert sorted(rows(views.inventory_by_center(inv))) == [("X", "a", 4), ("X", "b", 9), ("Y", "a", 4)]
