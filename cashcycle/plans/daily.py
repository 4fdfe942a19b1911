"""The daily run: kept cells, refreshed by the days that are new.

A folder keeps what the reports need of each region and day, as Parquet partitioned by both.
The rows of a partition, usually one file, are of three kinds:

* ``cells``: base cells, from which the cells of any report date follow;
* ``brands``: brand counts, which add up over days;
* ``skus``: sketches of the SKUs, which merge.

``days`` lists which days have been read, for all regions or for some. A refresh reads only
the days of the report's range that are not listed, usually one, writes their tables aside,
publishes them and lists the days last: a run that fails is repeated by the next one. Days
that the mart corrected later are read again on request. A report on kept cells equals one
on the whole mart.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashcycle.functions.periods import ReportPeriods, Span
from cashcycle.operators.brands import brand_day_counts, sum_of_days
from cashcycle.operators.cells import base_cells, cells_from_base
from cashcycle.operators.rows import rows_in
from cashcycle.operators.snapshot import sku_count_sketched, sku_sketches
from cashcycle.plans.report import (
    ReportOptions,
    brand_counts_of_rows,
    report_on_cells,
    sku_counts_of_rows,
)
from cashcycle.schema import DAY, REGION
from cashcycle.sources.mart import extract
from cashcycle.sources.publish import Publication

KIND = "kind"
KEPT = {"cells": base_cells, "brands": brand_day_counts, "skus": sku_sketches}
DAYS_SCHEMA = f"{REGION} string, {DAY} date"


def kept_rows(rows: DataFrame) -> DataFrame:
    """The rows of all kinds that are kept of extract rows."""
    kinds = [table(rows).withColumn(KIND, F.lit(name)) for name, table in KEPT.items()]
    return reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), kinds)


def read_kept(mart: DataFrame, path: str, name: str) -> DataFrame:
    """What is kept of one kind of ``mart``, of all regions and days there are."""
    none = extract(mart, Span(date.min, date.min))  # for its types; it is not read
    table = mart.sparkSession.read.schema(kept_rows(none).schema).parquet(f"{path.rstrip('/')}/kept")
    return table.where(F.col(KIND) == name).select(*KEPT[name](none).columns)


def days_read(
    spark: SparkSession, path: str, span: Span, regions: Iterable[str] | None = None
) -> set[date]:
    """The days of a range that have been read for all the regions asked for."""
    try:
        listed = spark.read.schema(DAYS_SCHEMA).parquet(f"{path.rstrip('/')}/days")
    except AnalysisException:
        return set()
    found: dict[date, set[str | None]] = {}
    for row in rows_in(listed, span).distinct().collect():
        found.setdefault(row[DAY], set()).add(row[REGION])
    asked = {None} if regions is None else set(regions)
    return {day for day, names in found.items() if None in names or asked <= names}


def refresh(
    mart: DataFrame,
    path: str,
    span: Span,
    regions: Iterable[str] | None = None,
    again: int = 0,
) -> list[date]:
    """Read the days of a range that are not kept yet, and the last ``again`` days anew.

    Returns the days that were read.
    """
    spark = mart.sparkSession
    regions = None if regions is None else sorted(set(regions))
    kept = days_read(spark, path, span, regions)
    late = span.end - timedelta(days=again)
    days = [day for day in span.dates() if day not in kept or day > late]
    if not days:
        return []
    rows = extract(mart, Span(days[0], days[-1]), regions)
    if len(days) < (days[-1] - days[0]).days + 1:
        rows = rows.where(F.col(DAY).isin(days))
    publication = Publication(spark, path)
    try:
        part = kept_rows(rows).hint("rebalance", REGION, DAY)
        publication.add("kept", part, (REGION, DAY), "parquet")
    except BaseException:
        publication.discard()
        raise
    texts = {day.isoformat() for day in days}
    publication.publish(
        lambda p: p[DAY] in texts and (regions is None or p[REGION] in regions)
    )
    listed = [(region, day) for region in regions or [None] for day in days]
    new = spark.createDataFrame(listed, DAYS_SCHEMA).coalesce(1)
    new.write.mode("append").parquet(f"{path.rstrip('/')}/days")
    return days


def daily_report(
    mart: DataFrame,
    path: str,
    as_of: date,
    regions: Iterable[str] | None = None,
    watchlist: DataFrame | None = None,
    options: ReportOptions = ReportOptions(),
    tables: Iterable[str] | None = None,
    again: int = 0,
) -> dict[str, DataFrame]:
    """The report tables for one date, reading only days of the mart that are not kept.

    Two options need rows of the mart: ``clean_brands`` those of the brand days, as rows that
    differ in a spelling only count once, and ``distinct_skus`` those of the report date.
    """
    periods = ReportPeriods(as_of)
    span = options.span(periods)
    regions = None if regions is None else list(regions)
    refresh(mart, path, span, regions, again)

    def kept(name: str, days: Span) -> DataFrame:
        table = rows_in(read_kept(mart, path, name), days)
        return table if regions is None else table.where(F.col(REGION).isin(regions))

    windows = periods.inbound_windows(options.month_window)
    cells = cells_from_base(kept("cells", span), as_of, windows)
    rows = extract(mart, span, regions)
    if options.clean_brands:
        counts = brand_counts_of_rows(rows, as_of, options)
    else:
        counts = sum_of_days(kept("brands", span), Span.trailing(as_of, options.brand_days))
    if options.sku_sketches:
        on_date = Span(as_of, as_of)
        skus = sku_count_sketched(kept("skus", on_date), on_date)
    else:
        skus = sku_counts_of_rows(rows, as_of, options)
    return report_on_cells(cells, counts, skus, as_of, watchlist, options, tables, regions)
