"""Command line: ``python -m rentalmart <command>`` (or ``spark-submit -m`` style launchers).

  ingest     landed CSV files -> raw tables, prints the load report      (J-37)
  build      raw tables -> models, tests, quality gate; prints the steps (J-38)
  freshness  freshness of the raw tables and the marts             (J-35, J-36)

The session comes from the launcher's configuration (master, resources, shared storage);
only unset options get this package's defaults. Paths are cluster paths (e.g. object
storage), never machine-local folders.
"""

from __future__ import annotations

import argparse
import sys

from rentalmart.session import get_session
from rentalmart.sources.schemas import RAW_TABLES


def _raw(spark, raw_dir: str, database: str | None):
    from rentalmart.sources import csv
    from rentalmart.sources.adapters import RawInputs
    read = {t: csv.read_raw(spark, raw_dir, t, database) for t in RAW_TABLES}
    return RawInputs(read["raw_listings"], read["raw_reviews"], read["raw_calendar"],
                     read["raw_neighbourhoods"])


def _raw_db(args) -> str | None:
    return f"{args.database}_raw" if args.database else None


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="rentalmart")
    sub = p.add_subparsers(dest="cmd", required=True)
    database = "use catalog tables: raw tables in <database>_raw, marts in <database>"
    ing = sub.add_parser("ingest")
    ing.add_argument("--landing", required=True, help="folder with <input>.csv[.gz] files")
    ing.add_argument("--raw", required=True, help="output folder for the raw tables")
    ing.add_argument("--database", help=database)
    bld = sub.add_parser("build")
    bld.add_argument("--raw", required=True)
    bld.add_argument("--warehouse", required=True)
    bld.add_argument("--database", help=database)
    bld.add_argument("--as-of", help="date for the review-date test (default: today)")
    bld.add_argument("--keep-going", action="store_true",
                     help="record failing tests instead of stopping")
    fr = sub.add_parser("freshness")
    fr.add_argument("--raw", required=True)
    fr.add_argument("--database", help=database)
    fr.add_argument("--warehouse", help="also report the freshness of the marts in this folder")
    fr.add_argument("--as-of")
    args = p.parse_args(argv)

    spark = get_session()
    if args.cmd == "ingest":
        from rentalmart.sources import csv
        landing = args.landing.rstrip("/")
        files = {t: csv.landed(spark, landing, name) for t, (name, _) in RAW_TABLES.items()}
        report = csv.load_raw(spark, files, args.raw, database=_raw_db(args))
        report.show(truncate=False)
        return 0
    if args.cmd == "build":
        from rentalmart.plans.pipeline import PipelineFailed, run_pipeline
        try:
            steps = run_pipeline(spark, _raw(spark, args.raw, _raw_db(args)), args.warehouse,
                                 args.as_of, raise_on_failure=not args.keep_going,
                                 database=args.database)
        except PipelineFailed as exc:
            print(f"pipeline stopped: {exc}", file=sys.stderr)
            return 1
        steps.show(100, truncate=False)
        return 0
    if args.cmd == "freshness":
        from rentalmart.plans import quality
        raw = _raw(spark, args.raw, _raw_db(args))
        models = {"raw_listings": raw.listings, "raw_reviews": raw.reviews,
                  "raw_calendar": raw.calendar}
        quality.all_source_freshness(models, args.as_of).show(truncate=False)
        if args.warehouse or args.database:
            from rentalmart.plans import facts, staging
            base = f"{args.database}." if args.database else args.warehouse.rstrip("/") + "/"
            quality.all_mart_freshness(
                staging.stg_listings(raw.listings), facts.read_fct_reviews(spark, base + "fct_reviews"),
                facts.read_fct_calendar(spark, base + "fct_calendar"), args.as_of).show(truncate=False)
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
