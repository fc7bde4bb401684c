"""Command line over the plans. Exits with 1 when a quality gate fails."""

import argparse
import sys

from studymart.operators.quality import QualityGateError, check_path
from studymart.plans import models
from studymart.plans.medallion import backfill, run_day
from studymart.session import build_session
from studymart.sources.tables import RAW_SCHEMAS, create_raw_tables, load_csv


def parse(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="studymart")
    commands = parser.add_subparsers(dest="command", required=True)

    day = commands.add_parser("run-day", help="process one landed day")
    day.add_argument("--date", required=True)

    span = commands.add_parser("backfill", help="process an inclusive range of days")
    span.add_argument("--start", required=True)
    span.add_argument("--end", required=True)

    for command in (day, span):
        command.add_argument("--base", required=True, help="URI above the raw, silver and gold folders")
        command.add_argument("--missing-ok", action="store_true")

    check = commands.add_parser("check", help="check stored events")
    check.add_argument("--path", required=True)

    load = commands.add_parser("load", help="load landed CSV files that a raw table has not loaded")
    load.add_argument("--database", required=True)
    load.add_argument("--table", required=True, choices=sorted(RAW_SCHEMAS))
    load.add_argument("--path", required=True)
    load.add_argument("--changed", choices=["raise", "skip", "append"], default="raise", help="files loaded in an older state")
    load.add_argument("--force", action="store_true", help="load files again that were loaded")

    build = commands.add_parser("models", help="build and test the marts from the raw tables")
    build.add_argument("--raw-database", required=True)
    build.add_argument("--database", required=True)
    build.add_argument("--buckets", type=int)

    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = parse(argv)
    spark = build_session(f"studymart-{args.command}")
    try:
        if args.command == "run-day":
            run_day(spark, args.base, args.date, args.missing_ok)
        elif args.command == "backfill":
            backfill(spark, args.base, args.start, args.end, args.missing_ok)
        elif args.command == "load":
            create_raw_tables(spark, args.database)
            table, schema = f"{args.database}.{args.table}", RAW_SCHEMAS[args.table]
            load_csv(spark, args.path, table, schema, changed=args.changed, force=args.force)
        elif args.command == "models":
            models.run(spark, args.raw_database, args.database, args.buckets)
        elif not check_path(spark, args.path):
            print("quality check failed", file=sys.stderr)
            return 1
    except QualityGateError as error:
        print(error, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
