"""Report job: ``spark-submit --py-files cashcycle.zip cashcycle/__main__.py ...``.

All regions are computed in one Spark job. Give the mart, or with ``--extract`` the
copy of an earlier extract.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashcycle.functions.periods import CALENDAR, ROLLING_30, ReportPeriods
from cashcycle.plans.daily import daily_report
from cashcycle.plans.report import (
    ALL_TABLES,
    ReportOptions,
    report_on_extract,
    write_report,
)
from cashcycle.schema import REGION
from cashcycle.sources.mart import extract, read_extract, read_mart, write_extract
from cashcycle.sources.watchlist import read_watchlist, read_watchlist_yaml


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="cashcycle", description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--mart", help="folder of the partitioned mart")
    source.add_argument("--extract", help="folder of a cached extract")
    parser.add_argument("--save-extract", help="also write the extract to this folder")
    parser.add_argument(
        "--extract-format", choices=("csv", "parquet"), default="csv", help="of either"
    )
    parser.add_argument("--kept", help="folder of kept cells: read new days of the mart only")
    parser.add_argument("--again", type=int, default=0, help="last days to read anew with --kept")
    parser.add_argument("--format", choices=("csv", "parquet"), default="csv", help="of the tables")
    parser.add_argument("--regions", nargs="+", help="default: all in the mart")
    parser.add_argument(
        "--date",
        type=lambda text: datetime.strptime(text, "%Y%m%d").date(),
        default=date.today() - timedelta(days=1),
        help="report date as yyyymmdd, default yesterday",
    )
    parser.add_argument("--watchlist", help="CSV of grass_region, supplier_name, or .yaml")
    parser.add_argument("--tables", nargs="+", choices=ALL_TABLES, help="default: all")
    parser.add_argument("--calendar-months", action="store_true")
    parser.add_argument("--month-window", choices=(ROLLING_30, CALENDAR), default=ROLLING_30)
    parser.add_argument("--distinct-skus", action="store_true")
    parser.add_argument("--category-on-report-date", action="store_true")
    parser.add_argument("--brand-ties", action="store_true")
    parser.add_argument("--clean-brands", action="store_true")
    parser.add_argument("--sku-sketches", action="store_true")
    parser.add_argument("--out", required=True, help="folder for the report tables")
    args = parser.parse_args(arguments)
    if args.kept and (args.extract or args.save_extract):
        parser.error("--kept needs --mart and has no extract")
    return args


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, str]:
    """Write the report tables; returns their folders by name."""
    options = ReportOptions(
        month_window=args.month_window,
        brand_days=31 if args.calendar_months else 30,
        distinct_skus=args.distinct_skus,
        sku_sketches=args.sku_sketches,
        category_on_report_date=args.category_on_report_date,
        brand_ties=args.brand_ties,
        clean_brands=args.clean_brands,
        calendar_months=args.calendar_months,
    )
    watchlist = None
    if args.watchlist:
        yaml = args.watchlist.endswith((".yaml", ".yml"))
        watchlist = (read_watchlist_yaml if yaml else read_watchlist)(spark, args.watchlist)
    if args.kept:
        report = daily_report(
            read_mart(spark, args.mart),
            args.kept,
            args.date,
            args.regions,
            watchlist,
            options,
            args.tables,
            args.again,
        )
    else:
        rows = _extract_rows(spark, args, options)
        report = report_on_extract(
            rows, args.date, watchlist, options, args.tables, args.regions
        )
    return write_report(report, args.out, args.format, args.regions)


def _extract_rows(
    spark: SparkSession, args: argparse.Namespace, options: ReportOptions
) -> DataFrame:
    if args.extract:
        rows = read_extract(spark, args.extract, args.extract_format)
        return rows.where(F.col(REGION).isin(args.regions)) if args.regions else rows
    span = options.span(ReportPeriods(args.date))
    rows = extract(read_mart(spark, args.mart), span, args.regions)
    if not args.save_extract:
        return rows
    write_extract(rows, args.save_extract, args.extract_format)
    return read_extract(spark, args.save_extract, args.extract_format)


if __name__ == "__main__":
    run(SparkSession.builder.appName("cashcycle").getOrCreate(), parse())
