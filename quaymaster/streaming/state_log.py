"""Running stock as a log: a base of all pairs, and deltas of what the batches changed.

What a batch does to a pair is a function of the stock it meets: with total t and least running sum m it makes
x + t + max(0, -(x + m)) of x, as nothing takes stock below zero. Functions compose without knowing x. So a batch
writes one row for each pair it touches and reads no state; deltas are composed with each other when they are many, and
folded into a new base when they hold half as many rows as it. The bytes written follow the batches, not the
state. Each batch publishes one version, so a batch that is repeated after a failure gives the same state.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quaymaster.functions.scalars import moment
from quaymaster.operators.accounting import PAIR
from quaymaster.operators.running import net_change
from quaymaster.sinks.segments import SegmentTable

MOST_DELTAS = 8
FOLD_SHARE = 0.5


def change_of(moves: DataFrame, order: list[str], seq: int, as_of: datetime, stamp: T.DataType) -> DataFrame:
    """What receipts and orders, in their order, do to every pair: (pair, seq, total, least, moved_at)."""
    signed = F.when(F.col("kind") == "receipt", F.col("units")).otherwise(-F.col("units"))
    rows = moves.select(*PAIR, *order, signed.cast("bigint").alias("_units"))
    return net_change(rows, PAIR, order, "_units").select(
        *PAIR, F.lit(seq).cast("bigint").alias("seq"), "total", "least", moment(as_of, stamp).alias("moved_at"))


def composed(changes: DataFrame) -> DataFrame:
    """One change for each pair: its changes one after the other. A pair has at most one in a segment, which bounds the list."""
    start = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(None).cast("bigint").alias("least"))
    step = lambda s, x: F.struct(
        (s["total"] + x["total"]).alias("total"), F.least(s["least"], s["total"] + x["least"]).alias("least"))
    listed = changes.groupBy(*PAIR).agg(F.sort_array(F.collect_list(F.struct("seq", "total", "least", "moved_at"))).alias("_all"))
    last, both = F.element_at("_all", -1), F.aggregate("_all", start, step)
    return listed.select(
        *PAIR, last["seq"].alias("seq"), both["total"].alias("total"), both["least"].alias("least"), last["moved_at"].alias("moved_at"))


def applied(state: DataFrame, change: DataFrame) -> DataFrame:
    """State after one change for each pair. Pairs that the state does not know are ignored."""
    stock, known = F.col("on_hand_qty"), F.col("total").isNotNull()
    moved = stock + F.col("total") + F.greatest(F.lit(0), -(stock + F.col("least")))
    return state.join(change.select(*PAIR, "total", "least", "moved_at"), PAIR, "left").withColumns({
        "on_hand_qty": F.when(known, moved).otherwise(stock),
        "last_updated": F.when(known, F.col("moved_at")).otherwise(F.col("last_updated")),
    }).select(*[F.col(f.name).cast(f.dataType) for f in state.schema])


def apply_moves(state: DataFrame, moves: DataFrame, order: list[str], as_of: datetime) -> DataFrame:
    """State after receipts and orders; one state after the other gives the same, however the moves are cut into batches."""
    return applied(state, change_of(moves, order, 0, as_of, state.schema["last_updated"].dataType))


@dataclass(frozen=True)
class StateLog:
    """State of ``schema`` (with the pair, ``on_hand_qty`` and ``last_updated``) below ``base``; version n is that after n batches."""

    spark: SparkSession
    base: str
    schema: T.StructType

    @property
    def table(self) -> SegmentTable:
        return SegmentTable(self.spark, self.base)

    @property
    def changes(self) -> T.StructType:
        pair = [T.StructField(c, self.schema[c].dataType) for c in PAIR]
        sums = [T.StructField(c, T.LongType()) for c in ("seq", "total", "least")]
        return T.StructType([*pair, *sums, T.StructField("moved_at", self.schema["last_updated"].dataType)])

    def start(self, state: DataFrame) -> None:
        """Version 0."""
        self.table.publish(0, [self.table.write(state.select(*self.schema.names), 0, kind="base")])

    def _read(self, segments: list[dict]) -> DataFrame:
        deltas = [s for s in segments if s["kind"] == "delta"]
        base = self.table.read([s for s in segments if s["kind"] == "base"], self.schema)
        if not deltas:
            return base
        changes = self.table.read(deltas, self.changes)
        return applied(base, composed(changes) if len(deltas) > 1 else changes)

    def read(self, version: int | None = None) -> DataFrame:
        """The state of a version, the newest by default."""
        return self._read(self.table.segments(self.table.newest() if version is None else version))

    def append(self, moves: DataFrame, version: int, order: list[str], as_of: datetime) -> None:
        """Publish ``version + 1``: version ``version`` after the moves of a batch."""
        table, now = self.table, version + 1
        change = change_of(moves, order, now, as_of, self.schema["last_updated"].dataType)
        before = table.segments(version)
        base = [s for s in before if s["kind"] == "base"]
        deltas = [s for s in before if s["kind"] == "delta"] + [table.write(change, now, kind="delta")]
        deltas = [s for s in deltas if s["rows"]]
        if sum(s["rows"] for s in deltas) >= FOLD_SHARE * max(1, sum(s["rows"] for s in base)):
            base, deltas = [table.write(self._read(base + deltas), now, kind="base")], []
        elif len(deltas) > MOST_DELTAS:
            deltas = [table.write(composed(table.read(deltas, self.changes)), now, kind="delta")]
        table.publish(now, base + deltas)
        table.clean()
