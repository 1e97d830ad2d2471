"""Hot and cold tiers as one table, and deduplication by event id."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from quaymaster import schemas
from quaymaster.functions.scalars import date_parts, instant
from quaymaster.operators.membership import Sketches, not_archived
from quaymaster.session import materialise


def unify(
    hot: DataFrame, cold: DataFrame, event_id: str, ts: str, cutoff: datetime | None = None, sketches: Sketches | None = None,
) -> DataFrame:
    """Hot and archived rows by column name, each event once.

    Archiving and deleting are not atomic, so a row may be in both tiers. Rows at or after the archive
    cutoff can only be hot. Hot rows before it are tested against the archive's sketches, and those that may be there are
    looked up by id in the partitions of their dates. Archived rows pass through as they are scanned, as the archive holds each id
    once. Without a cutoff nothing is known of the archive, and all rows are deduplicated.
    """
    archived = cold.drop(*[f.name for f in schemas.ARCHIVE_PARTS])
    if cutoff is None:
        return hot.unionByName(archived, allowMissingColumns=True).dropDuplicates([event_id])
    limit = instant(hot, ts, cutoff)
    late = materialise(hot.where(F.col(ts) < limit).withColumns(date_parts(F.col(ts))), "late-rows")
    new = not_archived(late, event_id, cold, sketches).select(*hot.columns)
    kept = hot.where((F.col(ts) >= limit) | F.col(ts).isNull())
    return kept.unionByName(new).unionByName(archived, allowMissingColumns=True)


def drop_duplicate_events(df: DataFrame, event_id: str) -> DataFrame:
    return df.dropDuplicates([event_id])


def orphans(fact: DataFrame, dimension: DataFrame, key: str, dimension_key: str | None = None) -> DataFrame:
    """Keys of a fact that its dimension lacks, with the rows that carry them.

    The fact is counted per key first, so a hot key reaches the join as one row.
    """
    known = dimension.select(F.col(dimension_key or key).alias(key))
    counted = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    return counted.join(known, key, "left_anti")


def missing_rows(fact: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a fact whose keys the other table lacks, for keys that are nearly unique: grouping first would save nothing."""
    return fact.join(other.select(*keys), keys, "left_anti")


def one_of_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key, whichever, by a sort of whole rows; ``dropDuplicates`` aggregates every column besides."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(keys[-1]))
    return df.withColumn("_nth", nth).where(F.col("_nth") == 1).drop("_nth")
