"""Merge the small files of the archive; with --expire delete what earlier runs have replaced."""

from __future__ import annotations

from quaymaster import schemas
from quaymaster.jobs.common import job_session, parser
from quaymaster.sinks import archive
from quaymaster.sinks.compaction import TARGET_BYTES


def main(argv: list[str] | None = None) -> None:
    arguments = parser(__doc__)
    arguments.add_argument("--archive", required=True, help="base path of the archive")
    arguments.add_argument("--target-mb", type=float, default=TARGET_BYTES / 2**20, help="size of a merged file")
    arguments.add_argument("--expire", action="store_true", help="delete replaced files instead, when no reader of the older list is left")
    args = arguments.parse_args(argv)
    with job_session("quaymaster-compact") as spark:
        for name in schemas.FACT_TIME:
            path, columns = f"{args.archive}/{name}", schemas.TABLES[name].fields
            if args.expire:
                done = archive.expire_replaced(spark, path, columns)
            else:
                done = archive.compact(spark, path, columns, schemas.FACT_ID[name], int(args.target_mb * 2**20))
            print(f"{name}: {done} files {'deleted' if args.expire else 'replaced'}")


if __name__ == "__main__":
    main()
