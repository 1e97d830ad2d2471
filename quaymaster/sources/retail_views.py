"""The domain tables as views over the benchmark tables.

Surrogates, where the benchmark tables have no such column: a distribution
center is a nation with a capacity of 50 m3 plus its key; stock snapshots are
order lines at the supplier's nation; a line fulfils at most 40 units. Order values
are decimals, so that their totals do not depend on the order of addition.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quaymaster import schemas
from quaymaster.functions.scalars import moment, ratio, stable_id
from quaymaster.session import size_tasks
from quaymaster.sources.tables import newest_time, scan

LINE_LIMIT = 40


def priority_level(priority: Column) -> Column:
    return (
        F.when(priority.isin("1-URGENT", "2-HIGH"), "HIGH")
        .when(priority.isin("3-MEDIUM", "4-NOT SPECIFIED"), "NORMAL")
        .otherwise("LOW")
    )


# What identifies an order line; order and line number alone are not unique.
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]


def line_id() -> Column:
    """Identifier of an order line, from its keys."""
    keys = [F.col(c) for c in LINE_KEYS[:4]]
    return stable_id(*keys, F.col("l_quantity").cast("int"), F.date_format("l_shipdate", "yyyy-MM-dd"))


class RetailViews:
    """Domain views over one folder of benchmark tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        size_tasks(spark, sum(size for _, _, size, _ in self.file_versions()))

    def table(self, name: str) -> DataFrame:
        return scan(self.spark, schemas.BENCHMARK[name], f"{self.folder}/{name}.parquet")

    def file_versions(self) -> list[tuple]:
        """Name, size and time of the files of the fact tables: metadata only."""
        found = []
        for name in ("lineitem", "orders", "customer", "supplier", "part"):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.parquet")
            files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for f in files.listStatus(path) if files.exists(path) else []:
                found.append((name, f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return sorted(found)

    # Dimensions -----------------------------------------------------------

    def regions(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name")
        )

    def dcs(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("dc_id"),
            F.col("n_name").alias("dc_name"),
            F.col("n_regionkey").alias("region_id"),
            (F.lit(50.0) + F.col("n_nationkey")).alias("capacity_m3"),
        )

    def skus(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("sku_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("unit_cost"),
            (F.col("p_size") / 1000).alias("storage_m3"),
            F.col("p_size").alias("demand_base_lambda"),
            (1 + F.col("p_size") % 5).alias("lead_time_days"),
            (3 + F.col("p_size") % 43).alias("stock_coverage_days"),
        )

    def suppliers(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            ratio(F.lit(80) + F.col("s_suppkey") % 20, F.lit(100)).alias("reliability_score"),
            (1 + F.col("s_suppkey") % 7).cast("double").alias("avg_lead_time_days"),
        )

    # Facts ----------------------------------------------------------------

    def order_lines(self) -> DataFrame:
        """Lines with their order and customer. Customers join the orders, which are fewer, so lines move once."""
        lines, orders, customers = self.table("lineitem"), self.table("orders"), self.table("customer")
        placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        return lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))

    def orders_fact(self) -> DataFrame:
        requested = F.col("l_quantity").cast("int")
        lost = F.greatest(requested - LINE_LIMIT, F.lit(0))
        return self.order_lines().select(
            line_id().alias(
                "order_line_id"
            ),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("sku_id"),
            F.col("c_nationkey").alias("dc_id"),
            requested.alias("requested_qty"),
            (requested - lost).alias("fulfilled_qty"),
            lost.alias("lost_sales_qty"),
            requested.alias("quantity"),
            (lost > 0).alias("lost_sale_flag"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias("order_value"),
            priority_level(F.col("o_orderpriority")).alias("priority_level"),
            F.col("o_orderdate").alias("order_ts"),
        )

    def shipments_fact(self, received_until: datetime | None = None) -> DataFrame:
        """Lines shipped after their order date; open if they arrive after ``received_until``."""
        arrival = F.col("l_shipdate")
        if received_until is not None:
            actual = F.when(arrival <= moment(received_until, "timestamp_ntz"), arrival)
        else:
            actual = arrival
        return (
            self.order_lines()
            .where(F.col("l_shipdate") > F.col("o_orderdate"))
            .select(
                line_id().alias(
                    "shipment_id"
                ),
                F.col("l_partkey").alias("sku_id"),
                F.col("l_suppkey").alias("supplier_id"),
                F.col("c_nationkey").alias("destination_dc_id"),
                F.col("l_quantity").cast("int").alias("quantity"),
                F.col("o_orderdate").alias("shipment_ts"),
                arrival.alias("expected_arrival_ts"),
                actual.alias("actual_arrival_ts"),
                F.datediff("l_shipdate", "o_orderdate").cast("double").alias("lead_time_days"),
            )
        )

    def inventory_fact(self) -> DataFrame:
        lines, suppliers, parts = self.table("lineitem"), self.table("supplier"), self.table("part")
        safety = F.col("p_size") % 20
        return (
            lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                line_id().alias(
                    "inventory_event_id"
                ),
                F.col("l_partkey").alias("sku_id"),
                F.col("s_nationkey").alias("dc_id"),
                F.col("l_quantity").cast("int").alias("on_hand_qty"),
                safety.alias("safety_stock"),
                (safety + 10).alias("reorder_point"),
                F.col("l_shipdate").alias("inventory_ts"),
            )
        )

    def _stock_lines(self, start: datetime | None) -> DataFrame:
        """Snapshots added up by part and supplier, then by part and the supplier's center.

        The lines are reduced before any dimension is joined, so a part with a large share of
        them reaches the joins as one row for each supplier.
        """
        lines = self.table("lineitem")
        if start is not None:
            lines = lines.where(F.col("l_shipdate") >= moment(start, "timestamp_ntz"))
        units = F.col("l_quantity").cast("int")
        newest = F.struct(F.col("l_shipdate").alias("ts"), units.alias("units"))
        by_supplier = lines.groupBy("l_partkey", "l_suppkey").agg(
            F.sum(units).alias("_sum"), F.count(units).alias("_count"), F.max(newest).alias("_newest"))
        centers = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("dc_id"))
        return (
            by_supplier.join(centers, "l_suppkey").groupBy(F.col("l_partkey").alias("sku_id"), "dc_id")
            .agg(F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count"), F.max("_newest").alias("_newest"))
        )

    def _safety(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("sku_id"), (F.col("p_size") % 20).alias("safety_stock"))

    def stock_rollup(self, start: datetime | None = None) -> DataFrame:
        """The stock roll-up of the KPIs (``kpis.inventory_rollup``) over the snapshots from ``start`` on."""
        return self._stock_lines(start).join(self._safety(), "sku_id").select(
            "sku_id", "dc_id", ratio(F.col("_sum"), F.col("_count")).alias("avg_on_hand"), F.col("_sum").alias("sum_on_hand"),
            F.col("_newest.units").alias("latest_on_hand"), F.col("safety_stock").cast("double").alias("avg_safety_stock"),
            F.col("safety_stock").alias("max_safety_stock"),
        )

    def inventory_state(self) -> DataFrame:
        """The newest snapshot of every SKU and distribution center."""
        return self._stock_lines(None).join(self._safety(), "sku_id").select(
            "sku_id", "dc_id", F.col("_newest.units").alias("on_hand_qty"), "safety_stock",
            (F.col("safety_stock") + 10).alias("reorder_point"), F.col("_newest.ts").alias("last_updated"),
        )

    def unit_costs(self) -> DataFrame:
        return self.skus().select("sku_id", F.col("unit_cost").cast("decimal(18,2)").alias("unit_cost"))

    def events(self) -> DataFrame:
        return self.table("events")

    # Newest event times: one row from one column of a base table -----------

    @cached_property
    def orders_as_of(self) -> datetime:
        return newest_time(self.table("orders"), "o_orderdate")

    @cached_property
    def inventory_as_of(self) -> datetime:
        return newest_time(self.table("lineitem"), "l_shipdate")

    @cached_property
    def events_as_of(self) -> datetime:
        return newest_time(self.table("events"), "ts")
