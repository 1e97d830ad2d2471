"""CASE bands: thresholds that turn a measure into a label."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# KPI thresholds.
STOCKOUT_DAYS = 7.0
CRITICAL_DAYS = 3.0
NO_DEMAND_DAYS = 9999.0
OVERLOADED_RATE = 0.85
HIGH_RATE = 0.70
NORMAL_RATE = 0.50

# Dashboard thresholds.
DASHBOARD_CRITICAL_PCT = 85
DASHBOARD_HIGH_PCT = 75
ALERTS_DANGER = 20
ALERTS_WARNING = 10

# Business rules on coverage.
UNDERSTOCK_DAYS = 2
OVERSTOCK_DAYS = 90
UTILISATION_TARGET = 0.75
UTILISATION_CRITICAL = 0.90


def _ladder_of(steps, default: Column) -> Column:
    """First matching condition wins; null conditions fall through."""
    (first, value), *rest = steps
    case = F.when(first, value)
    for condition, other in rest:
        case = case.when(condition, other)
    return case.otherwise(default)


def _ladder(steps, default: str) -> Column:
    return _ladder_of([(condition, F.lit(label)) for condition, label in steps], F.lit(default))


def days_of_cover(stock: Column, safety: Column, speed: Column) -> Column:
    """Days that the stock above its safety level lasts: none without such stock, ``NO_DEMAND_DAYS`` without demand."""
    spare = stock - safety
    return _ladder_of(
        [
            (stock.isNull() | (stock <= 0), F.lit(0.0)),
            (speed <= 0, F.lit(NO_DEMAND_DAYS)),
            (spare <= 0, F.lit(0.0)),
        ],
        F.try_divide(spare.cast("double"), speed),
    )


def stockout_severity(days: Column) -> Column:
    return _ladder([(days <= CRITICAL_DAYS, "Critical"), (days <= STOCKOUT_DAYS, "Warning")], "Normal")


def utilization_status(rate: Column) -> Column:
    return _ladder(
        [(rate >= OVERLOADED_RATE, "OVERLOADED"), (rate >= HIGH_RATE, "HIGH"), (rate >= NORMAL_RATE, "NORMAL")],
        "LOW",
    )


def alert_severity(days: Column) -> Column:
    return _ladder([(days < 1, "critical"), (days < 3, "high"), (days < 7, "medium")], "low")


def alert_band(days: Column) -> Column:
    return _ladder([(days < 1, "CRITICAL"), (days < 3, "HIGH"), (days < 7, "WARNING")], "LOW")


def dc_badge(percent: Column) -> Column:
    return _ladder([(percent > DASHBOARD_CRITICAL_PCT, "Critical"), (percent > DASHBOARD_HIGH_PCT, "High")], "Normal")


def traffic_light(value: Column, danger: float, warning: float) -> Column:
    return _ladder([(value > danger, "danger"), (value > warning, "warning")], "success")


def supplier_grade(score: Column) -> Column:
    return _ladder([(score >= 0.9, "A"), (score >= 0.8, "B"), (score >= 0.7, "C")], "D")


def hour_demand_factor(hour: Column) -> Column:
    """Demand multiplier by hour of day: working hours, evening, rest."""
    return F.when(hour.between(9, 17), 1.5).when(hour.between(18, 22), 1.2).otherwise(0.7)


def order_value_band(value: Column) -> Column:
    return _ladder([(value > 5000, "high"), (value > 1000, "medium")], "low")


def coverage_alert(days: Column) -> Column:
    return _ladder([(days < UNDERSTOCK_DAYS, "UNDERSTOCK"), (days > OVERSTOCK_DAYS, "OVERSTOCK")], "OK")


def capacity_alert(rate: Column) -> Column:
    return _ladder([(rate > UTILISATION_CRITICAL, "CRITICAL"), (rate > UTILISATION_TARGET, "ABOVE_TARGET")], "OK")


def freshness(age_seconds: Column, limit: int = 120) -> Column:
    """Fresh below the limit, Stale from it on, Unknown without a timestamp."""
    return (
        F.when(age_seconds.isNull(), F.lit("Unknown"))
        .when(age_seconds < limit, F.lit("Fresh"))
        .otherwise(F.lit("Stale"))
    )
