"""Rolling KPIs from partial sums: a batch adds its own, and what has left the window is dropped.

Rows of a batch are reduced to one row for each minute and key, which is written as a segment. A KPI over the
window merges the rows of its minutes, so it reads partial sums and never the facts of earlier batches. Segments that lie
before the window leave the list; when there are many, those that are left are merged to one row for each minute and
key. What a batch reads is bounded by the window, however many batches there have been. Each batch publishes one version, so a
repeated batch counts once.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quaymaster.functions.scalars import moment, ratio
from quaymaster.sinks.segments import SegmentTable

MOST_SEGMENTS = 8
EXACT = "decimal(18,6)"  # of lead times, so that sums can be merged in any order


@dataclass(frozen=True)
class Partial:
    """Mergeable sums of a fact by ``keys``: what a row adds, how sums merge, and the roll-up that they give."""

    ts: str
    keys: list[str]
    add: dict[str, Column] = field(repr=False)
    merge: dict[str, Callable[[str], Column]] = field(repr=False)
    finish: Callable[[DataFrame], DataFrame] = field(default=lambda df: df, repr=False)


def demand_partial() -> Partial:
    """Sums of ``kpis.demand_rollup``."""
    return Partial(
        "order_ts", ["sku_id", "dc_id"],
        {"total_ordered": F.sum("quantity"), "order_count": F.count("*"), "order_value": F.sum("order_value"),
         "valued_orders": F.count("order_value")},
        dict.fromkeys(["total_ordered", "order_count", "order_value", "valued_orders"], F.sum))


def stock_partial() -> Partial:
    """Sums of ``kpis.inventory_rollup``."""

    def finish(df: DataFrame) -> DataFrame:
        return df.select(
            "sku_id", "dc_id", ratio(F.col("_sum"), F.col("_count")).alias("avg_on_hand"), F.col("_sum").alias("sum_on_hand"),
            F.col("_newest.on_hand_qty").alias("latest_on_hand"), ratio(F.col("_safety"), F.col("_safeties")).alias("avg_safety_stock"),
            F.col("_most").alias("max_safety_stock"))

    return Partial(
        "inventory_ts", ["sku_id", "dc_id"],
        {"_sum": F.sum("on_hand_qty"), "_count": F.count("on_hand_qty"), "_newest": F.max(F.struct("inventory_ts", "on_hand_qty")),
         "_safety": F.sum("safety_stock"), "_safeties": F.count("safety_stock"), "_most": F.max("safety_stock")},
        {"_sum": F.sum, "_count": F.sum, "_newest": F.max, "_safety": F.sum, "_safeties": F.sum, "_most": F.max}, finish)


def lead_time_partial() -> Partial:
    """Sums of ``kpis.lead_times``: count, sum and squares give mean and sample deviation."""
    days = F.col("lead_time_days").cast(EXACT)

    def finish(df: DataFrame) -> DataFrame:
        n, total, squares = F.col("_n"), F.col("_sum").cast("double"), F.col("_squares").cast("double")
        spread = F.greatest(F.lit(0.0), squares - total * total / n)
        return df.select(
            "supplier_id", "shipment_count", ratio(total, n).alias("avg_lead_time_days"),
            F.when(n > 1, F.sqrt(spread / (n - 1))).alias("lead_time_std_dev"))

    return Partial(
        "shipment_ts", ["supplier_id"],
        {"shipment_count": F.count("*"), "_n": F.count("lead_time_days"), "_sum": F.sum(days), "_squares": F.sum(days * days)},
        dict.fromkeys(["shipment_count", "_n", "_sum", "_squares"], F.sum), finish)


@dataclass(frozen=True)
class PartialSums:
    """Partial sums of a fact with ``schema`` below ``base``; version n is that after n batches."""

    spark: SparkSession
    base: str
    partial: Partial
    schema: T.StructType

    @property
    def table(self) -> SegmentTable:
        return SegmentTable(self.spark, self.base)

    def _reduced(self, rows: DataFrame) -> DataFrame:
        minute = F.date_trunc("minute", F.col(self.partial.ts)).cast("timestamp").alias("minute")
        return rows.groupBy(minute, *self.partial.keys).agg(*[c.alias(k) for k, c in self.partial.add.items()])

    def _merged(self, sums: DataFrame, *keys: str) -> DataFrame:
        types = {f.name: f.dataType for f in sums.schema}
        return sums.groupBy(*keys).agg(*[f(k).cast(types[k]).alias(k) for k, f in self.partial.merge.items()])

    def _read(self, segments: list[dict], start: datetime) -> DataFrame:
        empty = self._reduced(self.spark.createDataFrame([], self.schema)).schema
        return self.table.read(segments, empty).where(F.col("minute") >= moment(start))

    def add(self, batch: DataFrame, version: int, start: datetime) -> None:
        """Publish ``version + 1``: the sums of version ``version`` and of a batch, from the minute ``start`` on."""
        table, now, mine = self.table, version + 1, self.partial
        before = table.segments(version) if version in table.versions() else []
        fresh = self._reduced(batch).where(F.col("minute") >= moment(start))
        last = {"last": F.date_format(F.max("minute"), "yyyy-MM-dd HH:mm")}
        kept = [s for s in before if s["last"] >= f"{start:%Y-%m-%d %H:%M}"] + [table.write(fresh, now, last)]
        kept = [s for s in kept if s["rows"]]
        if len(kept) > MOST_SEGMENTS:
            kept = [table.write(self._merged(self._read(kept, start), "minute", *mine.keys), now, last)]
        table.publish(now, kept)
        table.clean()

    def rollup(self, start: datetime, version: int | None = None) -> DataFrame:
        """The roll-up of the fact from the minute ``start`` on; empty before the first batch."""
        at = self.table.newest() if version is None else version
        segments = self.table.segments(at) if at is not None else []
        return self.partial.finish(self._merged(self._read(segments, start), *self.partial.keys))
