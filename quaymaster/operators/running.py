"""Running totals that no single key can overload.

A window ordered within a key runs in one task per key, and one key may hold a large
share of the rows. So the rows of a hot key are range partitioned by key and order, which spreads
it over many slices; each slice adds its own rows up, and the total of the earlier
slices of the same key is carried in. Where most keys are small (``floored_total``, ``net_change``), keys of at most
``HOT_ROWS`` rows are grouped by one exchange and only the others are sliced; ``running_total`` slices all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from quaymaster.session import materialise

HOT_ROWS = 200_000  # rows of a key that one task sorts; a key with more is sliced
BUCKETS = 1 << 16  # of keys, counted first


def _same_keys(keys: list[str], prefix: str) -> Column:
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def by_heat(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """The rows of keys that one task can sort, and those of the hot keys, or None if there are none.

    Buckets of keys are counted on the map side, and the keys of buckets that hold more rows than one task sorts are
    counted each. Of n rows at most n / ``HOT_ROWS`` keys are hot: that bound is what allows the broadcasts.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    many = lambda rows, *by: rows.groupBy(*by).agg(F.count("*").alias("_rows")).where(F.col("_rows") > HOT_ROWS).drop("_rows")
    full = materialise(many(df.select(bucket.alias("_bucket")), "_bucket"), "full-buckets")
    if full.isEmpty():
        return df, None
    suspects = df.select(*keys, bucket.alias("_bucket")).join(F.broadcast(full), "_bucket", "left_semi")
    hot = materialise(many(suspects, *keys).select(*[F.col(k).alias(f"_h_{k}") for k in keys]), "hot-keys")
    if hot.isEmpty():
        return df, None
    same = _same_keys(keys, "_h_")
    return df.join(F.broadcast(hot), same, "left_anti"), df.join(F.broadcast(hot), same, "left_semi")


def _slices(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows with the number of their slice; written, so that the number stays even if executors are lost later."""
    return materialise(df.repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id()), "slices")


def _same_slice(keys: list[str]) -> Column:
    return (F.col("_slice") == F.col("_c_slice")) & _same_keys(keys, "_c_")


def _carried_keys(keys: list[str]) -> list[Column]:
    return [F.col("_slice").alias("_c_slice"), *[F.col(k).alias(f"_c_{k}") for k in keys]]


def running_total(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the earlier rows of the same key.

    ``order`` has to be total within a key. A key that lies in several slices is the first or the last
    key of each of them, so the carried table has at most two rows per slice: that bound is what
    allows the broadcast.
    """
    sliced = _slices(df, keys, order)
    by_key = Window.partitionBy(*keys)
    earlier = by_key.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.groupBy("_slice", *keys)
        .agg(F.sum(value).alias("_total"))
        .withColumn("_slices", F.count("*").over(by_key))
        .where(F.col("_slices") > 1)
        .withColumn("_carry", F.sum("_total").over(earlier))
        .select(*_carried_keys(keys), "_carry")
    )
    inside = Window.partitionBy("_slice", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    return (
        sliced.withColumn("_inside", F.sum(value).over(inside))
        .join(F.broadcast(carried), _same_slice(keys), "left")
        .withColumn(out, F.coalesce("_inside", zero) + F.coalesce("_carry", zero))
        .select(*df.columns, out)
    )


def _runs(df: DataFrame, part: list[str], order: list[str], value: str) -> DataFrame:
    """Add the running sum ``_run`` of a part, its least value so far ``_low``, and that before the row ``_low_before``."""
    upto = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier_rows = upto.rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_run", F.sum(value).over(upto)).withColumns(
        {"_low": F.min("_run").over(upto), "_low_before": F.min("_run").over(earlier_rows)})


def _levels(value: str, before: str, after: str, carry: Column, carry_low: Column) -> dict[str, Column]:
    """Levels from the runs of a part and the two numbers that are carried into it."""
    total, floor = carry + F.col("_run"), lambda low: F.least(F.lit(0), carry_low, carry + F.col(low))
    return {before: total - F.col(value) - floor("_low_before"), after: total - floor("_low")}


def floored_total(df: DataFrame, keys: list[str], order: list[str], value: str, before: str, after: str) -> DataFrame:
    """Add the level of a key ``before`` and ``after`` each row, if it starts at zero, moves by ``value`` and never falls below zero.

    A row is the function x -> max(0, x + value), and rows in sequence compose to x -> max(a, x + b), with b their sum
    and a what the floor gives back. With running sum S and least running sum m (at most 0), the level is
    S - m. So a slice of a hot key is summed up by two numbers, its sum and its least running sum, and those of the earlier slices
    of a key compose to the two that are carried in. The rows are written once, as they are counted before they are grouped.
    """
    cold, hot = by_heat(materialise(df, "moves"), keys)
    nothing = F.lit(0).cast("bigint")
    levels = _runs(cold, keys, order, value).withColumns(_levels(value, before, after, nothing, nothing)).select(*df.columns, before, after)
    return levels if hot is None else levels.unionByName(_sliced_levels(hot, keys, order, value, before, after))


def _sliced_levels(df: DataFrame, keys: list[str], order: list[str], value: str, before: str, after: str) -> DataFrame:
    """``floored_total`` of hot keys. The bound of the broadcast is that of ``running_total``."""
    runs = materialise(_runs(_slices(df, keys, order), ["_slice", *keys], order, value), "runs")
    by_key = Window.partitionBy(*keys)
    earlier = by_key.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = F.coalesce("_carry", F.lit(0))
    carried = (
        runs.groupBy("_slice", *keys)
        .agg(F.sum(value).alias("_total"), F.min("_run").alias("_least"))
        .withColumn("_slices", F.count("*").over(by_key))
        .where(F.col("_slices") > 1)
        .withColumn("_carry", F.sum("_total").over(earlier))
        .withColumn("_carry_low", F.min(carry + F.col("_least")).over(earlier))
        .select(*_carried_keys(keys), "_carry", "_carry_low")
    )
    return (
        runs.join(F.broadcast(carried), _same_slice(keys), "left")
        .withColumns(_levels(value, before, after, carry, F.col("_carry_low")))
        .select(*df.columns, before, after)
    )


def net_change(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Sum ``total`` of ``value`` and least running sum ``least`` of every key.

    ``df`` is evaluated to count and again to add up, so it should be cheap to read.
    """
    cold, hot = by_heat(df, keys)
    run = lambda part: F.sum(value).over(Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    sums = [F.sum(value).alias("total"), F.min("_run").alias("least")]
    changes = cold.withColumn("_run", run(keys)).groupBy(*keys).agg(*sums)
    if hot is None:
        return changes
    parts = _slices(hot, keys, order).withColumn("_run", run(["_slice", *keys])).groupBy("_slice", *keys).agg(*sums)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    composed = parts.withColumn("least", F.coalesce(F.sum("total").over(earlier), F.lit(0)) + F.col("least")).groupBy(*keys).agg(
        F.sum("total").alias("total"), F.min("least").alias("least"))
    return changes.unionByName(composed)
