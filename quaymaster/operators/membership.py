"""Which rows an archive already holds, without moving the archive.

When rows are appended to an archive partition, their ids go into a sketch: the range of the ids and a Bloom filter in
blocks of eight words, of which an id marks one. A row that may be in the archive is tested against the sketches of its own partition, one
equality join for its block. The few that pass are looked up by id in the archive's partitions of their dates,
so the answer is exact; the rest are known to be new. Sketches hold about 1.3 bytes for each archived id.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quaymaster.session import materialise

PARTITION = ["event_date", "event_hour"]
WORDS = 8  # of 64 bits, to a block
BITS_OF_ID = 10  # of the filter, for each id
PROBES = 6  # bits that an id sets in its word


@dataclass(frozen=True)
class Sketches:
    """``parts``: a row for each partition and append, with its id range and number of blocks; ``blocks``: the filters."""

    parts: DataFrame
    blocks: DataFrame


def _place(event_id: str) -> Column:
    """Block of an id in a partition of ``blocks`` blocks."""
    return F.pmod(F.xxhash64(F.col(event_id).cast("string")), F.col("blocks"))


def _bits(event_id: str) -> tuple[Column, Column]:
    """The word of its block that an id marks, and the bits that it sets there."""
    spread = F.xxhash64(F.lit("bits"), F.col(event_id).cast("string"))
    field = lambda k, n: F.shiftrightunsigned(spread, k).bitwiseAND(F.lit(n - 1).cast("bigint")).cast("int")
    one = F.lit(1).cast("bigint")
    mask = reduce(lambda m, bit: m.bitwiseOR(bit), [F.call_function("shiftleft", one, field(3 + 6 * k, 64)) for k in range(PROBES)])
    return field(0, WORDS), mask


def count_parts(rows: DataFrame, event_id: str, run: str) -> DataFrame:
    """One row for each partition of ``rows``: how many, the range of their ids, and the blocks of their filter."""
    text = F.col(event_id).cast("string")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("ids") * BITS_OF_ID / (64 * WORDS))).cast("bigint")
    return rows.groupBy(*PARTITION).agg(
        F.count("*").alias("ids"), F.min(text).alias("low"), F.max(text).alias("high")
    ).withColumns({"blocks": blocks, "run": F.lit(run)})


def fill_blocks(rows: DataFrame, event_id: str, parts: DataFrame) -> DataFrame:
    """The filters of ``rows``: (partition, run, block, words)."""
    word, mask = _bits(event_id)
    placed = rows.select(*PARTITION, event_id).join(parts.select(*PARTITION, "run", "blocks"), PARTITION).select(
        *PARTITION, "run", _place(event_id).alias("block"), word.alias("word"), mask.alias("mask"))
    names = [f"w{i}" for i in range(WORDS)]
    nothing = F.lit(0).cast("bigint")
    return placed.groupBy(*PARTITION, "run", "block").agg(
        *[F.bit_or(F.when(F.col("word") == i, F.col("mask")).otherwise(nothing)).alias(n) for i, n in enumerate(names)]
    ).select(*PARTITION, "run", "block", F.array(*names).alias("words"))


def maybe_held(rows: DataFrame, event_id: str, sketches: Sketches) -> DataFrame:
    """Partition and id of the rows that the sketches of their partition do not rule out."""
    text = F.col(event_id).cast("string")
    near = rows.select(*PARTITION, event_id).join(sketches.parts, PARTITION).where(text.between(F.col("low"), F.col("high")))
    filters = near.withColumn("block", _place(event_id)).join(sketches.blocks, [*PARTITION, "run", "block"])
    word, mask = _bits(event_id)
    return filters.where(F.get("words", word).bitwiseAND(mask) == mask).select(*PARTITION, event_id)


def dates_of(rows: DataFrame) -> tuple | None:
    """First and last event date, to bound what an archive scan reads; None without rows."""
    found = rows.agg(F.min("event_date"), F.max("event_date")).first()
    return None if found[0] is None else (found[0], found[1])


def between_dates(archived: DataFrame, dates: tuple) -> DataFrame:
    return archived.where(F.col("event_date").between(F.lit(dates[0]), F.lit(dates[1])))


def not_archived(rows: DataFrame, event_id: str, archived: DataFrame, sketches: Sketches | None) -> DataFrame:
    """The rows (with the columns of ``PARTITION``) whose id the archive lacks.

    Without sketches every row is looked up. Only ids of the candidates' dates are read from the archive. The candidates are
    written, so Spark knows their size: where they fit a broadcast, as after a run whose delete went
    through, no archive row is shuffled.
    """
    near = rows.select(*PARTITION, event_id) if sketches is None else maybe_held(rows, event_id, sketches)
    candidates = materialise(near, "maybe-archived")
    dates = dates_of(candidates)
    if dates is None:
        return rows
    found = between_dates(archived, dates).select(event_id).join(candidates.select(event_id), event_id, "left_semi")
    return rows.join(found, event_id, "left_anti").select(*rows.columns)
