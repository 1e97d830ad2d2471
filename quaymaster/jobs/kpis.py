"""Compute and publish the KPIs of the rolling window."""

from __future__ import annotations

from quaymaster.jobs.common import job_session, parser, read_table, run_time, window_of
from quaymaster.plans.kpi_run import Dimensions, Facts, compute_kpis, publish
from quaymaster.sinks.serving import version_of, write_serving
from quaymaster.sources.tables import ANALYSIS_MINUTES, Period


def main(argv: list[str] | None = None) -> None:
    arguments = parser(__doc__)
    arguments.add_argument("--serving", required=True, help="path of the serving table")
    arguments.add_argument("--archive", help="archive to unite with the hot tables")
    arguments.add_argument("--top-levels", type=int, help="publish only so many stock levels, the highest; default all")
    arguments.add_argument("--top-alerts", type=int, help="publish only so many stockout alerts, the most urgent; default all")
    arguments.add_argument("--window-minutes", type=float, default=ANALYSIS_MINUTES)
    args = arguments.parse_args(argv)
    with job_session("quaymaster-kpis") as spark:
        period = Period(run_time(args), args.window_minutes)
        facts = Facts(
            *[window_of(spark, args, t, period, args.archive) for t in ("orders_fact", "inventory_fact", "shipments_fact")]
        )
        dims = Dimensions(*[read_table(spark, args, t) for t in ("skus_dim", "dcs_dim", "regions_dim", "suppliers_dim")])
        result = compute_kpis(facts, dims, period.days, keep=True)
        write_serving(publish(result, period, args.top_levels, args.top_alerts), args.serving, version_of(period.as_of))
        result.release()


if __name__ == "__main__":
    main()
