"""Move rows older than the cutoff from the hot tables to the archive."""

from __future__ import annotations

from pyspark.sql import functions as F

from quaymaster import schemas
from quaymaster.jobs.common import job_session, parser, read_table, run_time
from quaymaster.operators.quality import (
    ARCHIVE_THRESHOLD_MB, archive_needed, inventory_rules, orders_rules, shipments_rules, volume_report,
)
from quaymaster.sinks.archive import OLDER_THAN_MINUTES, ArchiveTable, run_archive

RULES = {"orders_fact": orders_rules, "inventory_fact": inventory_rules, "shipments_fact": shipments_rules}


def main(argv: list[str] | None = None) -> None:
    arguments = parser(__doc__)
    arguments.add_argument("--archive", required=True, help="base path of the archive")
    arguments.add_argument("--kept", help="folder for the new, complete version of the hot tables; without it nothing is deleted")
    arguments.add_argument("--older-than-minutes", type=int, default=OLDER_THAN_MINUTES)
    arguments.add_argument("--threshold-mb", type=float, default=ARCHIVE_THRESHOLD_MB, help="archive only above this size")
    args = arguments.parse_args(argv)
    with job_session("quaymaster-archive") as spark:
        hot = {name: read_table(spark, args, name) for name in schemas.FACT_TIME}
        if archive_needed(volume_report(hot), args.threshold_mb).first()["decision"] == "skip_archival":
            return
        tables = [
            ArchiveTable(
                name, rows, schemas.FACT_TIME[name], schemas.FACT_ID[name],
                F.col("actual_arrival_ts").isNotNull() if name == "shipments_fact" else None, tuple(RULES[name]()),
            )
            for name, rows in hot.items()
        ]
        keep = (lambda name, rows: rows.write.mode("overwrite").parquet(f"{args.kept}/{name}")) if args.kept else None
        _, errors = run_archive(spark, tables, args.archive, run_time(args), args.older_than_minutes, keep)
        if errors:
            raise SystemExit(f"not archived: {errors}")


if __name__ == "__main__":
    main()
