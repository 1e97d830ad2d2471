"""Arithmetic, time, identifier, formatting and coercion expressions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Size estimate of one record, and bytes per megabyte.
RECORD_BYTES = 500
MEGABYTE = 1024 * 1024

# Fixed value: canonical text form of a UUID.
UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null instead of an error when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def moment(value: datetime, dtype: str | T.DataType = "timestamp") -> Column:
    """A time as a literal. A value without zone is UTC, whatever the zone of the driver's machine."""
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ")).cast(dtype)


def instant(df: DataFrame, column: str, value: datetime) -> Column:
    """Literal of the column's own timestamp type, so that the filter is pushed to the scan."""
    return moment(value, df.schema[column].dataType)


def date_parts(ts: Column) -> dict[str, Column]:
    return {
        "event_date": F.to_date(ts),
        "event_year": F.year(ts),
        "event_month": F.month(ts),
        "event_day": F.dayofmonth(ts),
        "event_hour": F.hour(ts),
    }


def before(ts: Column, minutes: float) -> Column:
    return ts - F.make_dt_interval(mins=F.lit(int(minutes)))


def plus_days(ts: Column, days: Column) -> Column:
    """Timestamp plus a fractional number of days, exact to the microsecond."""
    micros = F.round(days.cast("double") * F.lit(86_400_000_000.0)).cast("bigint")
    return F.timestamp_micros(F.unix_micros(ts.cast("timestamp")) + micros)


def plus_hours(ts: Column, hours: Column) -> Column:
    return plus_days(ts, hours.cast("double") / F.lit(24.0))


def age_seconds(ts: Column, as_of: Column) -> Column:
    return F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp(ts.cast("timestamp"))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def parse_iso(text: Column) -> Column:
    """ISO text with or without fraction, ``Z`` or offset; null when malformed."""
    return F.try_to_timestamp(text)


def display_time(text: Column) -> Column:
    return F.date_format(parse_iso(text), "yyyy-MM-dd HH:mm:ss")


def size_mb(records: Column) -> Column:
    return F.round(records * F.lit(RECORD_BYTES) / F.lit(MEGABYTE), 2)


def stable_id(*parts: Column) -> Column:
    """UUID-shaped identifier derived from the row, equal on every rerun."""
    digest = F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)
    spans = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in spans])


def is_uuid(text: Column) -> Column:
    return text.cast("string").rlike(UUID_PATTERN)


def thousands(value: Column, digits: int = 0) -> Column:
    return F.format_number(value, digits)


def fixed(value: Column, digits: int) -> Column:
    """A fixed number of decimals, without separators."""
    return F.call_function("format_number", value, F.lit("0." + "0" * digits))


def compact_number(value: Column) -> Column:
    """Millions as ``1.23M``, thousands as ``1.2K``, otherwise a whole number."""
    return (
        F.when(value >= 1_000_000, F.concat(fixed(value / 1_000_000, 2), F.lit("M")))
        .when(value >= 1_000, F.concat(fixed(value / 1_000, 1), F.lit("K")))
        .otherwise(F.format_number(value, 0))
    )


def money_card(value: Column) -> Column:
    """Revenue card: thousands below one million, millions from it on."""
    return F.when(
        value < 1_000_000, F.concat(F.lit("$"), fixed(value / 1_000, 1), F.lit("K"))
    ).otherwise(F.concat(F.lit("$"), fixed(value / 1_000_000, 2), F.lit("M")))


def percent_text(percent: Column) -> Column:
    return F.concat(fixed(percent, 1), F.lit("%"))


def to_number(column: Column, default: float = 0.0) -> Column:
    """Number, or the default when missing or malformed."""
    return F.coalesce(column.cast("string").try_cast("double"), F.lit(float(default)))


def first_present(df: DataFrame, names: list[str]) -> Column | None:
    """The first of several synonymous columns that the frame has."""
    return next((F.col(name) for name in names if name in df.columns), None)


def clamp(value: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def whole(value: Column, dtype: str = "int") -> Column:
    """Truncation towards zero."""
    return value.cast(T.LongType() if dtype == "bigint" else T.IntegerType())
