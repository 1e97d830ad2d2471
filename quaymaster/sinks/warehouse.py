"""Shipments and stock that change together: a receiving run is one commit.

Receiving stamps the arrival on shipments and adds their units to the stock of their pair. Both are written as deltas
(who has arrived; what that does to a pair) and become visible by one published list. A run that fails before
that has changed nothing, and a run after it finds the shipments received, so nothing is received twice.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quaymaster.functions.scalars import instant, moment
from quaymaster.operators.accounting import PAIR, due_shipments, received_units
from quaymaster.sinks.segments import SegmentTable
from quaymaster.streaming.state_log import StateLog, applied, composed

MOST_DELTAS = 8


@dataclass(frozen=True)
class Warehouse:
    """Versions of shipments and state below ``base``."""

    spark: SparkSession
    base: str
    shipments_schema: T.StructType
    state_schema: T.StructType

    @property
    def table(self) -> SegmentTable:
        return SegmentTable(self.spark, self.base)

    @property
    def _arrivals(self) -> T.StructType:
        return T.StructType([T.StructField("shipment_id", self.shipments_schema["shipment_id"].dataType),
                             T.StructField("_arrived", self.shipments_schema["actual_arrival_ts"].dataType)])

    @property
    def _changes(self) -> T.StructType:
        return StateLog(self.spark, self.base, self.state_schema).changes

    def start(self, shipments: DataFrame, state: DataFrame) -> None:
        """Version 0."""
        parts = {"shipments": shipments.select(*self.shipments_schema.names), "state": state.select(*self.state_schema.names)}
        self.table.publish(0, [self.table.write(rows, 0, kind=kind) for kind, rows in parts.items()])

    def add_shipments(self, shipments: DataFrame) -> None:
        """Publish further shipments."""
        now = self.table.newest() + 1
        self.table.publish(now, self._now() + [self.table.write(shipments.select(*self.shipments_schema.names), now, kind="shipments")])

    def _now(self) -> list[dict]:
        return self.table.segments(self.table.newest())

    def _of(self, segments: list[dict], kind: str, schema: T.StructType) -> DataFrame:
        return self.table.read([s for s in segments if s["kind"] == kind], schema)

    def _shipments(self, segments: list[dict]) -> DataFrame:
        sent = self._of(segments, "shipments", self.shipments_schema)
        arrived = F.coalesce("actual_arrival_ts", "_arrived")
        return sent.join(self._of(segments, "arrivals", self._arrivals), "shipment_id", "left").withColumn(
            "actual_arrival_ts", arrived).select(*self.shipments_schema.names)

    def _state(self, segments: list[dict]) -> DataFrame:
        return applied(self._of(segments, "state", self.state_schema), composed(self._of(segments, "changes", self._changes)))

    def shipments(self) -> DataFrame:
        """All shipments, with the arrival of those received."""
        return self._shipments(self._now())

    def state(self) -> DataFrame:
        return self._state(self._now())

    def receive(self, as_of: datetime, limit: int | None = None) -> int:
        """Receive all due shipments, or the first ``limit`` of them; returns how many."""
        table, before = self.table, self._now()
        now = table.newest() + 1
        due = due_shipments(self._shipments(before), as_of, limit)
        arrivals = table.write(
            due.select("shipment_id", instant(due, "expected_arrival_ts", as_of).cast(self._arrivals["_arrived"].dataType).alias("_arrived")),
            now, kind="arrivals")
        if not arrivals["rows"]:
            return 0
        # The units are those of the written arrivals, so both deltas speak of the same shipments.
        got = self._of(before, "shipments", self.shipments_schema).join(table.read([arrivals], self._arrivals), "shipment_id", "left_semi")
        change = received_units(got).select(
            *PAIR, F.lit(now).cast("bigint").alias("seq"), F.col("delta").cast("bigint").alias("total"), F.col("delta").cast("bigint").alias("least"),
            moment(as_of, self.state_schema["last_updated"].dataType).alias("moved_at"))
        segments = before + [arrivals, table.write(change.select(*self._changes.names), now, kind="changes")]
        table.publish(now, self._folded(segments, now))
        table.clean()
        return arrivals["rows"]

    def _folded(self, segments: list[dict], now: int) -> list[dict]:
        """The list with many deltas replaced by the tables that they lead to."""
        if len([s for s in segments if s["kind"] == "arrivals"]) <= MOST_DELTAS:
            return segments
        return [self.table.write(self._shipments(segments), now, kind="shipments"), self.table.write(self._state(segments), now, kind="state")]
