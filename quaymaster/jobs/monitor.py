"""Write the quality, volume and freshness reports of the hot tables."""

from __future__ import annotations

from quaymaster import schemas
from quaymaster.jobs.common import job_session, parser, read_table, run_time
from quaymaster.operators import quality
from quaymaster.operators.quality import Reference


def main(argv: list[str] | None = None) -> None:
    arguments = parser(__doc__)
    arguments.add_argument("--reports", required=True, help="folder of the reports")
    args = arguments.parse_args(argv)
    with job_session("quaymaster-monitor") as spark:
        tables = {name: read_table(spark, args, name) for name in schemas.TABLES if name != "inventory_state"}
        orders, stock, sent = (tables[t] for t in ("orders_fact", "inventory_fact", "shipments_fact"))
        skus, dcs, suppliers = (tables[t] for t in ("skus_dim", "dcs_dim", "suppliers_dim"))
        rules = quality.quality_report(
            [
                quality.check_rules(orders, "orders_fact", quality.orders_rules()),
                quality.check_rules(stock, "inventory_fact", quality.inventory_rules()),
                quality.check_rules(sent, "shipments_fact", quality.shipments_rules()),
                quality.check_references(orders, "orders_fact", [Reference("sku_id", skus), Reference("dc_id", dcs)]),
                quality.check_references(stock, "inventory_fact", [Reference("sku_id", skus), Reference("dc_id", dcs)]),
                quality.check_references(sent, "shipments_fact", [Reference("supplier_id", suppliers), Reference("destination_dc_id", dcs, "dc_id")]),
            ]
        )
        facts = {name: (tables[name], ts) for name, ts in schemas.FACT_TIME.items()}
        reports = {
            "quality": rules,
            "volume": quality.volume_report(tables),
            "freshness": quality.fact_freshness(facts, run_time(args)),
        }
        for name, report in reports.items():
            report.write.mode("overwrite").json(f"{args.reports}/{name}")


if __name__ == "__main__":
    main()
