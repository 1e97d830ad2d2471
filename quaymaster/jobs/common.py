"""Arguments and tables shared by the jobs."""

from __future__ import annotations

import argparse
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from quaymaster import schemas
from quaymaster.operators.setops import unify
from quaymaster.session import build_session, scratch_scope
from quaymaster.sinks.archive import read_archive
from quaymaster.sinks.sketches import read_sketches
from quaymaster.sources.tables import Period, newest_time, recent, scan, scan_archive


def parser(description: str) -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(description=description)
    out.add_argument("--tables", help="folder of the hot tables and dimensions; not needed by a connector")
    out.add_argument("--format", default="parquet", help="source format, or the name of a connector on the classpath")
    out.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="option of the source")
    out.add_argument("--table-option", default="collection", help="connector option that names the table")
    out.add_argument("--as-of", type=datetime.fromisoformat, help="time of the run, default now (UTC)")
    return out


@contextmanager
def job_session(name: str) -> Iterator[SparkSession]:
    """Session of a job, whose derived tables are deleted at its end."""
    spark = build_session(name)
    with scratch_scope(spark):
        yield spark


def run_time(args) -> datetime:
    """Time of the run in UTC, without zone."""
    value = args.as_of or datetime.now(timezone.utc)
    return value if value.tzinfo is None else value.astimezone(timezone.utc).replace(tzinfo=None)


def read_table(spark: SparkSession, args, table: str) -> DataFrame:
    """A hot table or dimension, by path or through a connector."""
    options = dict(pair.split("=", 1) for pair in args.option)
    if args.tables:
        return scan(spark, schemas.TABLES[table], f"{args.tables}/{table}", args.format, **options)
    return scan(spark, schemas.TABLES[table], None, args.format, **{**options, args.table_option: table})


def window_of(spark: SparkSession, args, table: str, period: Period, cold: str | None = None) -> DataFrame:
    """Rows of a fact within the period, with the archived ones where an archive is given.

    Only hot rows up to the newest archived time can be in both tiers.
    """
    ts = schemas.FACT_TIME[table]
    hot = recent(read_table(spark, args, table), ts, period)
    if cold is None or read_archive(spark, f"{cold}/{table}", schemas.TABLES[table].fields) is None:
        return hot
    archived = scan_archive(spark, cold, table, period.start)
    newest = newest_time(archived, ts)
    if newest is None:
        return hot
    sketches = read_sketches(spark, f"{cold}/{table}")
    return unify(hot, archived, schemas.FACT_ID[table], ts, newest + timedelta(microseconds=1), sketches)
