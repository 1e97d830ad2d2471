"""Streaming transformations and their queries.

The benchmark tables carry timestamps without zone; event time has to be a timestamp
with zone, so every source is cast in ``event_time``.
"""

from __future__ import annotations

from datetime import datetime
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from quaymaster.functions.scalars import date_parts
from quaymaster.operators.quality import Rule, observed_rules, rule_report
from quaymaster.sinks.archive import PARTITION_COLUMNS
from quaymaster.sinks.sketches import read_sketches
from quaymaster.streaming.partials import PartialSums
from quaymaster.streaming.state_log import StateLog

# Event-time bound and KPI window.
LATENESS = "2 minutes"
WINDOW = "15 minutes"
SLIDE = "1 minute"

ARCHIVE_SPREAD = 8  # tasks that may write one partition in a micro-batch, by default


def event_time(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def _aggregates(value: str):
    return [F.count("*").alias("event_count"), F.sum(value).alias("total_value")]


def _flat(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys,
        "event_count", "total_value",
    )


def sliding_kpis(df: DataFrame, ts: str, keys: list[str], value: str, window: str = WINDOW, slide: str = SLIDE,
                 lateness: str = LATENESS) -> DataFrame:
    """Count and sum per key over a rolling window, emitted when the window closes.

    The rows are first added up per slide and then per window. A row thus enters one
    state entry of its slide instead of one per window that covers it.
    """
    steps = (
        event_time(df, ts).withWatermark(ts, lateness)
        .groupBy(F.window(ts, slide), *keys)
        .agg(*_aggregates(value))
    )
    rolled = (
        steps.withColumn("_at", F.window_time("window")).drop("window")
        .groupBy(F.window("_at", window, slide), *keys)
        .agg(F.sum("event_count").alias("event_count"), F.sum("total_value").alias("total_value"))
    )
    return _flat(rolled, keys)


def tumbling_volumes(df: DataFrame, ts: str, keys: list[str], value: str, width: str = SLIDE,
                     lateness: str = LATENESS) -> DataFrame:
    """Count and sum per key and minute."""
    counted = event_time(df, ts).withWatermark(ts, lateness).groupBy(F.window(ts, width), *keys).agg(*_aggregates(value))
    return _flat(counted, keys)


def deduplicated(df: DataFrame, ts: str, event_id: str, lateness: str = LATENESS) -> DataFrame:
    """Each event once, as long as its copies arrive within the lateness bound."""
    return event_time(df, ts).withWatermark(ts, lateness).dropDuplicatesWithinWatermark([event_id])


def enriched(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Stream rows with the attributes of a static dimension."""
    return df.join(dimension, key, "left")


def to_files(df: DataFrame, path: str, checkpoint: str, partitions: list[str] | None = None) -> StreamingQuery:
    """Everything available now, appended to a Parquet folder exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.trigger(availableNow=True).start(path)


def to_archive(df: DataFrame, ts: str, event_id: str, path: str, checkpoint: str, lateness: str = LATENESS,
               spread: int = ARCHIVE_SPREAD) -> StreamingQuery:
    """Streaming archive in the layout of the batch archive, each event once within the lateness bound.

    The rows of a partition go to at most ``spread`` tasks of a micro-batch, so a busy hour is
    written in parallel; ``archive.compact`` merges the files of many micro-batches. A stream writes no id sketches, so it is refused for an
    archive that has some: its rows would be taken for new ones.
    """
    if read_sketches(df.sparkSession, path) is not None:
        raise ValueError(f"{path} has id sketches; a stream does not keep them up")
    parted = deduplicated(df, ts, event_id, lateness).withColumns(date_parts(F.col(ts)))
    part = F.pmod(F.xxhash64(event_id), F.lit(spread))
    return to_files(parted.repartition(*PARTITION_COLUMNS, part), path, checkpoint, PARTITION_COLUMNS)


def checked(df: DataFrame, rules: list[Rule], name: str = "rules") -> DataFrame:
    """A stream whose rows are counted against rules on their way to its sink, for ``stream_rule_report``."""
    return df.observe(name, *observed_rules(rules))


def stream_rule_report(run: StreamingQuery, table: str, rules: list[Rule], name: str = "rules") -> DataFrame:
    """(table, rule, checked, violations) over the micro-batches whose progress the query still holds: a few numbers each."""
    seen = [p.observedMetrics[name].asDict() for p in run.recentProgress if name in p.observedMetrics]
    totals = {k: sum(m[k] for m in seen) for k in ["checked", *[r.name for r in rules]]}
    return rule_report(SparkSession.active(), table, totals, rules)


def publish_each_batch(df: DataFrame, publish: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Call ``publish(frame, batch_id)`` for each micro-batch; it must overwrite by batch id."""
    return df.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def keep_partials(df: DataFrame, sums: PartialSums, start: datetime, checkpoint: str,
                  then: Callable[[int], None] | None = None) -> StreamingQuery:
    """Add every micro-batch to partial sums that begin at ``start``, then call ``then(version)``."""

    def add(batch: DataFrame, batch_id: int) -> None:
        sums.add(batch, batch_id, start)
        if then is not None:
            then(batch_id + 1)

    return publish_each_batch(df, add, checkpoint)


def run_state(moves: DataFrame, log: StateLog, order: list[str], checkpoint: str, as_of: datetime) -> StreamingQuery:
    """Running stock per pair from a stream of receipts and orders that arrive in event order.

    ``moves`` has ``kind`` ('receipt' or 'order'), the pair, ``units`` and the columns of ``order``. The log has been started with
    the initial state; micro-batch n makes version n + 1 of version n.
    """
    return publish_each_batch(moves, lambda batch, batch_id: log.append(batch, batch_id, order, as_of), checkpoint)
