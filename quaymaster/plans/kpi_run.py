"""The KPI job: windowed facts in, one serving table out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from quaymaster.operators import kpis, views
from quaymaster.sinks import serving
from quaymaster.sources.tables import Period


@dataclass(frozen=True)
class Facts:
    """Facts already limited to the analysis window."""

    orders: DataFrame
    inventory: DataFrame | None
    shipments: DataFrame


@dataclass(frozen=True)
class Dimensions:
    skus: DataFrame
    dcs: DataFrame
    regions: DataFrame
    suppliers: DataFrame


@dataclass(frozen=True)
class KpiSet:
    inventory: DataFrame
    stockouts: DataFrame
    suppliers: DataFrame
    utilization: DataFrame
    regional: DataFrame
    rollups: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        for frame in self.rollups:
            frame.unpersist()


def compute_kpis(facts: Facts, dims: Dimensions, period_days: float, keep: bool = False, stock: DataFrame | None = None) -> KpiSet:
    """All five KPIs from three aggregations.

    Each fact is scanned and shuffled once: the stock and demand roll-ups have one row
    per SKU and center and serve two or three KPIs each. ``keep`` persists them for a run
    with several actions. ``stock`` gives the stock roll-up where the snapshots have been rolled up before.
    """
    stock = kpis.inventory_rollup(facts.inventory) if stock is None else stock
    return kpis_from(stock, kpis.demand_rollup(facts.orders), kpis.lead_times(facts.shipments), dims, period_days, keep)


def kpis_from(
    stock: DataFrame, demand: DataFrame, leads: DataFrame, dims: Dimensions, period_days: float, keep: bool = False
) -> KpiSet:
    """All five KPIs from the roll-ups of the three facts."""
    if keep:
        stock, demand = (df.persist(StorageLevel.MEMORY_AND_DISK) for df in (stock, demand))
    cover = kpis.days_of_cover(stock, demand, period_days)
    return KpiSet(
        inventory=kpis.inventory_level_from(stock, dims.skus, dims.dcs),
        stockouts=kpis.stockout_risk_from(cover, dims.skus, dims.dcs, dims.regions),
        suppliers=kpis.supplier_scores_from(leads, dims.suppliers),
        utilization=kpis.dc_utilization_from(stock, dims.skus, dims.dcs),
        regional=kpis.regional_performance_from(demand, dims.dcs, dims.regions),
        rollups=(stock, demand) if keep else (),
    )


def publish(result: KpiSet, period: Period, top_levels: int | None = None, top_alerts: int | None = None) -> DataFrame:
    """Serving table of a run: records, counters and metadata.

    Every record is published; with ``top_levels`` or ``top_alerts`` that KPI is a numbered top list.
    """
    as_of = period.as_of
    alerts = result.stockouts.agg(F.count("*"))
    return serving.serving_table(
        [
            serving.metadata(result.inventory.sparkSession, as_of, period.minutes),
            serving.records(
                result.inventory, serving.INVENTORY_KEY, kpis.level_order(), as_of,
                top_levels,
            ),
            serving.records(
                result.stockouts, serving.STOCKOUT_KEY, kpis.risk_order(), as_of,
                top_alerts,
            ),
            serving.records(result.suppliers, serving.SUPPLIER_KEY, [], as_of),
            serving.records(result.utilization, serving.UTILIZATION_KEY, [], as_of),
            serving.records(result.regional, serving.REGIONAL_KEY, [], as_of),
            serving.counter(alerts, serving.STOCKOUT_COUNT_KEY, as_of),
            serving.counter(kpis.overloaded_count(result.utilization), serving.OVERLOADED_COUNT_KEY, as_of),
        ]
    )


def dashboard(result: KpiSet) -> DataFrame:
    """The executive totals of a run."""
    return views.executive_totals(
        result.inventory, result.stockouts, result.suppliers, result.utilization, result.regional
    )
