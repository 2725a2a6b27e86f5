"""Command line: load the landing table, build or refresh the warehouse, check it.

    spark-submit farelake/__main__.py ingest  --source trips/ --landing landing/ --start 2022-01-01 --end 2022-04-01
    spark-submit farelake/__main__.py build   --landing landing/ --zones zones.csv --out warehouse/
    spark-submit farelake/__main__.py ingest  --source trips/ --landing landing/ --start 2022-03-01 --end 2022-04-01 --months 2022-03-01
    spark-submit farelake/__main__.py refresh --landing landing/ --zones zones.csv --out warehouse/

The session takes its master and sizes from the submit command; see the README.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from farelake import schemas  # noqa: E402
from farelake.operators import quality  # noqa: E402
from farelake.operators.clean import ROW_ORDER  # noqa: E402
from farelake.plans import warehouse  # noqa: E402
from farelake.session import build_session, release_scratch  # noqa: E402
from farelake.sources import landing, lookups  # noqa: E402
from farelake.sources.versions import Versions  # noqa: E402


def parse(arguments: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="farelake", description="Trip warehouse on Spark")
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    commands = parser.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest", help="replace the landing table, or months of it, by a range of the source")
    ingest.add_argument("--source", required=True)
    ingest.add_argument("--start", required=True)
    ingest.add_argument("--end", required=True)
    ingest.add_argument("--months", nargs="+", metavar="DAY", help="replace only these months, given by their first days")
    ingest.add_argument("--share", type=float, help="keep this share of the rows, chosen by a hash of their key")

    build = commands.add_parser("build", help="build all tables and check them")
    refresh = commands.add_parser("refresh", help="bring all tables up to date with the landing table")
    for command in (build, refresh):
        command.add_argument("--zones", required=True, help="zone lookup CSV")
        command.add_argument("--out", required=True)
        command.add_argument("--partitions", type=int, help="parts to number the trips in")
    for command in (ingest, build, refresh):
        command.add_argument("--landing", required=True)
        command.add_argument("--as-of", default=now, help="load time (default: now, UTC)")
    return parser.parse_args(arguments)


def ingest(spark: SparkSession, args: argparse.Namespace) -> int:
    source = spark.read.schema(schemas.SOURCE_TRIPS).parquet(args.source)
    trips = landing.extract_range(source, args.start, args.end)
    if args.share is not None:
        trips = landing.sample_share(trips, args.share, ROW_ORDER)
    store = Versions(spark, args.landing)
    landing.load(store, landing.add_sync_columns(trips, args.as_of), args.months)
    landing.load_summary(landing.read_landing(store)).show(truncate=False)
    return 0


def build(spark: SparkSession, args: argparse.Namespace) -> int:
    landed, out = Versions(spark, args.landing), Versions(spark, args.out)
    known = warehouse.Lookups.with_zones(spark, lookups.read_csv(spark, args.zones, schemas.ZONES))
    make = warehouse.refresh if args.command == "refresh" else warehouse.build
    report = make(landed, out, known, args.as_of, args.partitions)
    quality.freshness(landing.read_landing(landed), args.as_of).show(truncate=False)
    return outcome(report)


def outcome(report: DataFrame) -> int:
    """Print the checks, worst first; 1 if any failed."""
    found = sorted(report.collect(), key=lambda r: (["fail", "warn", "pass"].index(r.status), r.table_name))
    for r in found:
        print(f"{r.status:5} {r.check_name:20} {r.table_name}.{r.column_name or '*'}: {r.violations}")
    return int(any(r.status == "fail" for r in found))


def main(arguments: list[str] | None = None) -> int:
    args = parse(sys.argv[1:] if arguments is None else arguments)
    spark = build_session()
    try:
        return ingest(spark, args) if args.command == "ingest" else build(spark, args)
    finally:
        release_scratch(spark)


if __name__ == "__main__":
    sys.exit(main())
