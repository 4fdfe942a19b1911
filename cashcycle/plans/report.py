"""The whole report for all regions in one run."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from cashcycle.functions.periods import ROLLING_30, SHORT_DAYS, ReportPeriods, Span
from cashcycle.operators.brands import brand_counts, canonical_brands
from cashcycle.operators.cells import daily_totals, supplier_day_cells
from cashcycle.operators.matrices import daily_matrices
from cashcycle.operators.quality import period_coverage
from cashcycle.operators.rows import rows_in
from cashcycle.operators.snapshot import (
    main_category,
    main_category_snapshot,
    sku_count_distinct,
    sku_count_sketched,
    sku_sketches,
)
from cashcycle.operators.watchlist import on_watchlist
from cashcycle.operators.windows import scorecard_sums, working_capital_days
from cashcycle.plans.scorecard import scorecard
from cashcycle.plans.sheets import matrix_table, sheet
from cashcycle.plans.tracking import TRACKING_CELLS, ranked_brands, tracking
from cashcycle.schema import (
    COGS,
    INBOUND,
    INVENTORY,
    PAYABLES,
    REGION,
    SUPPLIER,
)
from cashcycle.sources.mart import CSV_FILE_ROWS, CSV_OPTIONS, extract
from cashcycle.sources.publish import Publication
from cashcycle.sources.storage import stage

#: Report tables that hold one matrix each.
MATRICES = {
    "payable": PAYABLES,
    "cogs": COGS,
    "inventory": INVENTORY,
    "inbound": INBOUND,
}

SUPPLIER_TABLES = ("tracking", "tracking_yaml", "scorecard")
ALL_TABLES = (
    *SUPPLIER_TABLES,
    *MATRICES,
    *(f"sheet_{name}" for name in MATRICES),
    "working_capital",
    "coverage",
)


@dataclass(frozen=True)
class ReportOptions:
    """Choices on which report versions differ."""

    #: Inbound windows: 30 days to each period end, or whole months at month ends.
    month_window: str = ROLLING_30
    #: Days of brand history; the calendar-month report uses 31.
    brand_days: int = SHORT_DAYS
    #: Count different SKUs instead of SKU rows.
    distinct_skus: bool = False
    #: Count different SKUs by sketches, which keep a bounded size; takes precedence.
    sku_sketches: bool = False
    #: Main category on the report date instead of each supplier's latest day.
    category_on_report_date: bool = False
    #: Brands with equal counts share a rank; the first three fill the places.
    brand_ties: bool = False
    #: Give brands written without blanks their spelling with blanks before counting.
    clean_brands: bool = False
    #: Start at the first day of the month before last, not 90 days before its end.
    calendar_months: bool = False

    def span(self, periods: ReportPeriods) -> Span:
        if self.calendar_months:
            return periods.monthly_extract_span
        return periods.extract_span


def run_report(
    mart: DataFrame,
    as_of: date,
    regions: Iterable[str] | None = None,
    watchlist: DataFrame | None = None,
    options: ReportOptions = ReportOptions(),
    tables: Iterable[str] | None = None,
) -> dict[str, DataFrame]:
    """The report tables for one date, for all or some regions, keyed by name.

    ``tables`` limits the report to the tables asked for.
    """
    wanted = asked_tables(tables, options)
    regions = None if regions is None else list(regions)
    rows = extract(mart, options.span(ReportPeriods(as_of)), regions)
    return report_on_extract(rows, as_of, watchlist, options, wanted, regions)


def asked_tables(tables: Iterable[str] | None, options: ReportOptions) -> tuple[str, ...]:
    """The tables to make: by default all there are with these options."""
    missing = {"scorecard"} if options.calendar_months else set()
    if tables is None:
        return tuple(name for name in ALL_TABLES if name not in missing)
    tables = tuple(tables)
    unknown = [name for name in tables if name not in ALL_TABLES or name in missing]
    if unknown:
        raise ValueError(f"this report has no table {', '.join(unknown)}")
    return tables


def report_on_extract(
    rows: DataFrame,
    as_of: date,
    watchlist: DataFrame | None = None,
    options: ReportOptions = ReportOptions(),
    tables: Iterable[str] | None = None,
    regions: Iterable[str] | None = None,
) -> dict[str, DataFrame]:
    """The report tables from extract rows, such as a cached extract.

    Rows outside the report's range of days are left out.

    The rows are read once for the supplier-day cells, which feed every table, and
    once more over the brand days, whose de-duplication needs whole rows. The
    calendar-month report has no scorecard. ``regions`` are those that the coverage table
    lists even if they have no rows.
    """
    periods = ReportPeriods(as_of)
    rows = rows_in(rows, options.span(periods))
    windows = periods.inbound_windows(options.month_window)
    cells = supplier_day_cells(rows, as_of, windows)
    counts = brand_counts_of_rows(rows, as_of, options)
    skus = sku_counts_of_rows(rows, as_of, options)
    return report_on_cells(cells, counts, skus, as_of, watchlist, options, tables, regions)


def brand_counts_of_rows(rows: DataFrame, as_of: date, options: ReportOptions) -> DataFrame:
    span = Span.trailing(as_of, options.brand_days)
    branded = rows_in(rows, span)
    if options.clean_brands:
        branded = canonical_brands(branded)
    return brand_counts(branded, span)


def sku_counts_of_rows(rows: DataFrame, as_of: date, options: ReportOptions) -> DataFrame | None:
    if options.sku_sketches:
        on_date = Span(as_of, as_of)
        return sku_count_sketched(sku_sketches(rows_in(rows, on_date)), on_date)
    return sku_count_distinct(rows, as_of) if options.distinct_skus else None


def report_on_cells(
    cells: DataFrame,
    counts: DataFrame,
    skus: DataFrame | None,
    as_of: date,
    watchlist: DataFrame | None = None,
    options: ReportOptions = ReportOptions(),
    tables: Iterable[str] | None = None,
    regions: Iterable[str] | None = None,
) -> dict[str, DataFrame]:
    """The report tables from supplier-day cells, brand counts and, unless SKU rows are to be
    counted, SKU counts.

    Tables that others build on are written to shared storage, so that writing the report
    repeats no work. All matrices and daily sheets are columns of one grouping of the daily
    totals.
    """
    periods = ReportPeriods(as_of)
    span = options.span(periods)
    windows = periods.inbound_windows(options.month_window)
    wanted = set(asked_tables(tables, options))
    if wanted <= {"tracking", "tracking_yaml"}:
        cells = cells.select(*TRACKING_CELLS)
    cells = stage(cells, "cells")
    categories = (
        main_category_snapshot(cells, as_of)
        if options.category_on_report_date
        else main_category(cells)
    )
    if len(wanted) > 1:
        categories = stage(categories, "categories")
    report = {}
    if wanted & set(SUPPLIER_TABLES):
        brands = ranked_brands(counts, options.brand_ties)
        everyone = tracking(cells, brands, as_of, categories, skus)
        if len(wanted & set(SUPPLIER_TABLES)) > 1:
            everyone = stage(everyone, "tracking")
        watched = everyone if watchlist is None else on_watchlist(everyone, watchlist)
        report |= {"tracking": everyone, "tracking_yaml": watched}
        if "scorecard" in wanted and not options.calendar_months:
            report["scorecard"] = scorecard(
                watched, scorecard_sums(cells, periods, windows)
            )
    if "coverage" in wanted:
        report["coverage"] = period_coverage(cells, periods, regions)
    if wanted - set(SUPPLIER_TABLES) - {"coverage"}:
        daily = stage(daily_totals(cells), "daily")
    if "working_capital" in wanted:
        report["working_capital"] = working_capital_days(daily, periods)
    shown = [m for name, m in MATRICES.items() if wanted & {name, f"sheet_{name}"}]
    if shown:
        wide = stage(daily_matrices(daily, shown, span), "matrices")
    for name, measure in MATRICES.items():
        if name in wanted:
            report[name] = matrix_table(wide, categories, measure, span)
        if f"sheet_{name}" in wanted:
            spans = _sheet_windows(measure, periods, options)
            zero = options.calendar_months
            report[f"sheet_{name}"] = sheet(wide, categories, measure, spans, span, zero)
    return {name: table for name, table in report.items() if name in wanted}


def _sheet_windows(
    measure: str, periods: ReportPeriods, options: ReportOptions
) -> Mapping[str, Span]:
    if options.calendar_months:
        return periods.calendar_windows()
    if measure == INBOUND:
        return periods.inbound_windows(options.month_window)
    return periods.trailing_windows()


def write_report(
    tables: Mapping[str, DataFrame],
    path: str,
    fmt: str = "csv",
    regions: Iterable[str] | None = None,
) -> dict[str, str]:
    """Write each table to its own folder under ``path``, one partition per region.

    ``regions`` are those the report was made for, all by default: their old rows are
    replaced, or go if there are no new ones, and other regions' tables stay. All tables are
    written aside before the first is published, so a run that fails leaves the old ones.

    Rows are sorted by supplier inside a region. Returns the folders by table.
    """
    asked = None if regions is None else set(regions)
    folders: dict[str, str] = {}
    if not tables:
        return folders
    options = {**CSV_OPTIONS, "maxRecordsPerFile": CSV_FILE_ROWS} if fmt == "csv" else {}
    publication = Publication(next(iter(tables.values())).sparkSession, path)
    try:
        for name, table in tables.items():
            folders[name] = publication.add(name, in_output_order(table), (REGION,), fmt, **options)
    except BaseException:
        publication.discard()
        raise
    publication.publish(lambda partition: asked is None or partition[REGION] in asked)
    return folders


def in_output_order(table: DataFrame) -> DataFrame:
    """Rows by region and supplier, as the report shows them."""
    return table.orderBy(*[c for c in (REGION, SUPPLIER) if c in table.columns])
