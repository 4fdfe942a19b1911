"""Registered queries: every report operator over the star tables of a folder.

Each query derives the mart columns it needs from the tables under ``path`` and
runs over all regions, suppliers and rows of the report's range of days. Exact
decimals are turned into doubles at the very end.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashcycle.functions import periods as P
from cashcycle.functions.periods import CALENDAR, ReportPeriods, Span
from cashcycle.operators import brands, matrices, quality, rows, snapshot, windows
from cashcycle.operators.cells import daily_totals, supplier_day_cells
from cashcycle.operators.watchlist import on_watchlist
from cashcycle.plans import scorecard as scorecards
from cashcycle.plans.daily import daily_report, refresh
from cashcycle.plans.report import ReportOptions, run_report, write_report
from cashcycle.plans.sheets import matrix_table, sheet
from cashcycle.plans.tracking import TRACKING_CELLS, supplier_brands, tracking
from cashcycle.schema import (
    BRAND,
    CATEGORY,
    COGS,
    COLOR,
    CREATED,
    DAY,
    EXTRACT_COLUMNS,
    FLOWS,
    INBOUND,
    INVENTORY,
    KEYS,
    MART_COLUMNS,
    MEASURES,
    PAYABLES,
    PURCHASE_TYPE,
    REGION,
    SKU,
    STOCKS,
    SUPPLIER,
    TERMS,
    UNITS,
)
from cashcycle.sources.mart import (
    CSV_OPTIONS,
    extract,
    read_extract,
    read_mart,
    write_extract,
    write_mart,
)
from cashcycle.sources.star import read_table, star_mart
from cashcycle.sources.storage import new_path, stage
from cashcycle.sources.watchlist import read_watchlist

Query = Callable[[SparkSession, str], DataFrame]

#: The report date of the queries, and a month end after a leap February.
MID_MONTH = ReportPeriods(date(1998, 11, 18))
MONTH_END = ReportPeriods(date(1996, 3, 31))

REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
SOME_REGIONS = ("AFRICA", "EUROPE", "MIDDLE EAST")
OTHER_REGIONS = ("AMERICA", "ASIA")
UNLISTED_REGION = "EUROPE"
WATCHED_BALANCE = 4000


def with_doubles(table: DataFrame) -> DataFrame:
    """Decimals as doubles."""
    return table.to(
        T.StructType(
            [
                T.StructField(f.name, T.DoubleType())
                if isinstance(f.dataType, T.DecimalType)
                else f
                for f in table.schema.fields
            ]
        )
    )


def extract_rows(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    span: Span = MID_MONTH.extract_span,
) -> DataFrame:
    """Extract rows with the supplier, the day and the given columns only."""
    wanted = [c for c in EXTRACT_COLUMNS if c in {*KEYS, DAY, *columns}]
    mart = star_mart(spark, path, [*wanted, PURCHASE_TYPE], outright=True)
    return extract(mart, span, columns=wanted)


def report_cells(
    spark: SparkSession, path: str, periods: ReportPeriods, mode: str = P.ROLLING_30
) -> DataFrame:
    """The supplier-day cells of one report."""
    columns = [c for c in EXTRACT_COLUMNS if c != BRAND]
    source = extract_rows(spark, path, columns, periods.extract_span)
    return supplier_day_cells(source, periods.as_of, periods.inbound_windows(mode))


def brand_rows(spark: SparkSession, path: str, span: Span) -> DataFrame:
    return extract_rows(spark, path, EXTRACT_COLUMNS, span)


# --- sources and row level -------------------------------------------------------


def mart_extract(spark: SparkSession, path: str) -> DataFrame:
    return extract_rows(spark, path, EXTRACT_COLUMNS)


def extract_roundtrip(spark: SparkSession, path: str) -> DataFrame:
    target = new_path(spark, "extract")
    write_extract(mart_extract(spark, path), target)
    return read_extract(spark, target)


def extract_roundtrip_inferred(spark: SparkSession, path: str) -> DataFrame:
    target = new_path(spark, "extract")
    write_extract(mart_extract(spark, path), target)
    copy = read_extract(spark, target, schema=None)
    return copy.withColumn(SKU, F.col(SKU).cast("string"))


def mart_roundtrip(spark: SparkSession, path: str) -> DataFrame:
    """COGS windows over the mart as a table partitioned by region and day."""
    span = MID_MONTH.extract_span
    target = new_path(spark, "mart")
    write_mart(star_mart(spark, path, MART_COLUMNS).where(span.contains()), target)
    source = extract(read_mart(spark, target), span)
    return windows.period_sums(source, COGS, MID_MONTH.trailing_windows())


def report_roundtrip(spark: SparkSession, path: str) -> DataFrame:
    table = tracking_table(spark, path)
    folders = write_report({"tracking": table}, new_path(spark, "report"))
    return read_extract(spark, folders["tracking"], schema=table.schema)


def report_in_turns(spark: SparkSession, path: str) -> DataFrame:
    """The tracking table that reports for some of the regions leave in one folder: a
    later run replaces its own regions and keeps the others."""
    table = stage(tracking_table(spark, path), "tracking")
    target = new_path(spark, "report")
    folders = {}
    for regions in (SOME_REGIONS, REGIONS[1:], OTHER_REGIONS, REGIONS[:1]):
        own = table.where(F.col(REGION).isin(list(regions)))
        folders = write_report({"tracking": own}, target, regions=regions)
    return read_extract(spark, folders["tracking"], schema=table.schema)


def matrix_roundtrip(spark: SparkSession, path: str) -> DataFrame:
    """The four matrices, written as CSV, read back and turned into long form."""
    daily = stage(all_daily_totals(spark, path), "daily")
    span = MID_MONTH.extract_span
    tables = {m: matrices.daily_matrix(daily, m, span) for m in (*FLOWS, *STOCKS)}
    folders = write_report(tables, new_path(spark, "report"))
    copies = [
        matrices.matrix_to_long(
            read_extract(spark, folders[measure], schema=table.schema), measure
        )
        for measure, table in tables.items()
    ]
    return reduce(lambda one, two: one.join(two, [*KEYS, DAY], "full"), copies)


def snapshot_rows(spark: SparkSession, path: str) -> DataFrame:
    return rows.snapshot_rows(mart_extract(spark, path), MID_MONTH.as_of)


def trailing_rows(spark: SparkSession, path: str) -> DataFrame:
    source = extract_rows(spark, path, [SKU, BRAND])
    return rows.rows_in(source, Span.trailing(MID_MONTH.as_of, P.SHORT_DAYS))


def month_rows(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Extract rows moved to their month's end: several a supplier and day, and copies."""
    source = extract_rows(spark, path, columns, MONTH_END.extract_span)
    return source.withColumn(DAY, F.last_day(DAY))


def dedup_rows(spark: SparkSession, path: str) -> DataFrame:
    return rows.distinct_rows(month_rows(spark, path, [COLOR, TERMS]))


def supplier_spine(spark: SparkSession, path: str) -> DataFrame:
    return rows.supplier_spine(extract_rows(spark, path, []))


def row_flags(spark: SparkSession, path: str) -> DataFrame:
    source = extract_rows(spark, path, [SKU, CREATED, COLOR, INBOUND, INVENTORY])
    return rows.row_flags(source, MID_MONTH.inbound_windows())


# --- periods ---------------------------------------------------------------------


def period_calendar(spark: SparkSession, path: str) -> DataFrame:
    """The period dates of a report on any day the mart has rows for."""
    days = star_mart(spark, path, [DAY]).distinct()
    day = F.col(DAY)
    m2, m1 = P.month_end_before(day, 2), P.month_end_before(day, 1)
    return days.select(
        day.alias("as_of"),
        m2.alias("m2_eop"),
        m1.alias("m1_eop"),
        day.alias("m0_eop"),
        P.trailing_start(m2, P.TRAILING_DAYS).alias("extract_start"),
        F.trunc(m2, "MM").alias("monthly_extract_start"),
        P.days_in_month(m2).alias("days_m2"),
        P.days_in_month(m1).alias("days_m1"),
        P.days_in_current_period(day).alias("days_m0"),
        P.last_completed_month_end(day).alias("last_month_end"),
        P.trailing_start(day, P.SHORT_DAYS).alias("rolling_start"),
        P.calendar_window_start(day).alias("calendar_start"),
        P.day_text(day).alias("as_of_text"),
    )


def calendar_spine(spark: SparkSession, path: str) -> DataFrame:
    return quality.calendar_spine(extract_rows(spark, path, []), MID_MONTH.extract_span)


def period_coverage(spark: SparkSession, path: str) -> DataFrame:
    return quality.period_coverage(extract_rows(spark, path, []), MID_MONTH)


# --- snapshot --------------------------------------------------------------------


def _snapshot(operator: Callable, *columns: str) -> Query:
    """An operator on a date on which suppliers have several rows."""

    def query(spark: SparkSession, path: str) -> DataFrame:
        return operator(month_rows(spark, path, columns), MONTH_END.as_of)

    return query


def latest_date(spark: SparkSession, path: str) -> DataFrame:
    return snapshot.latest_date(extract_rows(spark, path, []))


def main_category(spark: SparkSession, path: str) -> DataFrame:
    return snapshot.main_category(extract_rows(spark, path, [CATEGORY, INVENTORY]))


# --- daily totals and windows ----------------------------------------------------


def _daily(
    spark: SparkSession,
    path: str,
    measures: Sequence[str],
    span: Span = MID_MONTH.extract_span,
) -> DataFrame:
    return daily_totals(extract_rows(spark, path, measures, span), tuple(measures))


def all_daily_totals(spark: SparkSession, path: str) -> DataFrame:
    return _daily(spark, path, MEASURES)


def _flow(measure: str, periods: ReportPeriods, spans: Mapping[str, Span]) -> Query:
    """Window sums straight from the rows: one shuffle."""

    def query(spark: SparkSession, path: str) -> DataFrame:
        source = extract_rows(spark, path, [measure], periods.extract_span)
        return windows.period_sums(source, measure, spans)

    return query


def _stock(measure: str) -> Query:
    """Window means, which need the daily totals first."""

    def query(spark: SparkSession, path: str) -> DataFrame:
        daily = _daily(spark, path, [measure])
        return windows.period_means(daily, measure, MID_MONTH.trailing_windows())

    return query


def _replenishment(operator: Callable, periods: ReportPeriods, mode: str) -> Query:
    def query(spark: SparkSession, path: str) -> DataFrame:
        columns = [CREATED, COLOR, INBOUND]
        source = extract_rows(spark, path, columns, periods.extract_span)
        spans = periods.inbound_windows(mode)
        return operator(rows.with_replenishment(source, spans), spans)

    return query


def eop_inventory(spark: SparkSession, path: str) -> DataFrame:
    return windows.eop_inventory(extract_rows(spark, path, [INVENTORY]), MID_MONTH)


def black_stock(spark: SparkSession, path: str) -> DataFrame:
    source = extract_rows(spark, path, [COLOR, INVENTORY])
    return windows.black_stock(rows.with_black_inventory(source), MID_MONTH)


def l30_inventory_days(spark: SparkSession, path: str) -> DataFrame:
    source = extract_rows(spark, path, [COGS, INVENTORY])
    return windows.l30_inventory_days(source, MID_MONTH)


def _monthly_flows(periods: ReportPeriods) -> Query:
    def query(spark: SparkSession, path: str) -> DataFrame:
        source = extract_rows(spark, path, FLOWS, periods.monthly_extract_span)
        return windows.monthly_flow_sums(source, periods)

    return query


def monthly_stock_means(spark: SparkSession, path: str) -> DataFrame:
    daily = _daily(spark, path, STOCKS, MID_MONTH.monthly_extract_span)
    return windows.monthly_stock_means(daily, MID_MONTH)


def working_capital_days(spark: SparkSession, path: str) -> DataFrame:
    daily = _daily(spark, path, [COGS, INVENTORY, PAYABLES])
    return windows.working_capital_days(daily, MID_MONTH)


# --- brands ----------------------------------------------------------------------

BRAND_SPAN = Span.trailing(MID_MONTH.as_of, P.SHORT_DAYS)
LONG_BRAND_SPAN = Span.trailing(MID_MONTH.as_of, P.SHORT_DAYS + 1)


def brand_counts(spark: SparkSession, path: str) -> DataFrame:
    return brands.brand_counts(brand_rows(spark, path, BRAND_SPAN), BRAND_SPAN)


def top_brands(spark: SparkSession, path: str) -> DataFrame:
    return brands.top_brands(brand_counts(spark, path))


def top_brands_ranked(spark: SparkSession, path: str) -> DataFrame:
    source = brand_rows(spark, path, LONG_BRAND_SPAN)
    return brands.top_brands_ranked(brands.brand_counts(source, LONG_BRAND_SPAN))


def top_brands_wide(spark: SparkSession, path: str) -> DataFrame:
    return brands.top_brands_wide(top_brands(spark, path))


def top_brands_ranked_wide(spark: SparkSession, path: str) -> DataFrame:
    return brands.top_brands_wide(top_brands_ranked(spark, path))


def brand_canonical(spark: SparkSession, path: str) -> DataFrame:
    """Clean-up of part names that are spelled with and without blanks.

    The spelling follows the part size, so that both forms of a name occur.
    """
    lines = read_table(spark, path, "lineitem")
    parts = read_table(spark, path, "part")
    name = F.col("p_name")
    spelled = F.when(F.col("p_size") <= 20, name).otherwise(
        F.replace(name, F.lit(" "), F.lit(""))
    )
    source = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", spelled.alias(BRAND)
    )
    return brands.canonical_brands(source)


# --- matrices and reports --------------------------------------------------------


def _matrix(measure: str) -> Query:
    def query(spark: SparkSession, path: str) -> DataFrame:
        daily = _daily(spark, path, [measure])
        return matrices.daily_matrix(daily, measure, MID_MONTH.extract_span)

    return query


def matrix_with_category(spark: SparkSession, path: str) -> DataFrame:
    source = extract_rows(spark, path, [CATEGORY, COGS, INVENTORY])
    cells, span = category_cells(source, COGS), MID_MONTH.extract_span
    wide = matrices.daily_matrices(daily_totals(cells, (COGS,)), [COGS], span)
    return matrix_table(wide, snapshot.main_category(cells), COGS, span)


def category_cells(source: DataFrame, measure: str) -> DataFrame:
    """Daily totals of one measure by category, with what ranks the categories."""
    measures = tuple(sorted({measure, INVENTORY}))
    return stage(daily_totals(source, measures, by=(CATEGORY,)), "cells")


def _sheet(measure: str) -> Query:
    def query(spark: SparkSession, path: str) -> DataFrame:
        columns = {measure, CATEGORY, INVENTORY}
        cells = category_cells(extract_rows(spark, path, list(columns)), measure)
        spans = (
            MID_MONTH.inbound_windows()
            if measure == INBOUND
            else MID_MONTH.trailing_windows()
        )
        return sheet_of(cells, measure, spans, MID_MONTH.extract_span)

    return query


def sheet_of(
    cells: DataFrame,
    measure: str,
    spans: Mapping[str, Span],
    span: Span,
    zero_if_none: bool = False,
) -> DataFrame:
    wide = matrices.daily_matrices(daily_totals(cells, (measure,)), [measure], span)
    categories = snapshot.main_category(cells)
    return sheet(wide, categories, measure, spans, span, zero_if_none)


def _tracking_from(
    spark: SparkSession, path: str, cells: DataFrame, periods: ReportPeriods
) -> DataFrame:
    span = Span.trailing(periods.as_of, P.SHORT_DAYS)
    top = supplier_brands(brand_rows(spark, path, span), span)
    return tracking(cells, top, periods.as_of)


def tracking_table(spark: SparkSession, path: str) -> DataFrame:
    cells = report_cells(spark, path, MID_MONTH).select(*TRACKING_CELLS)
    return _tracking_from(spark, path, stage(cells, "cells"), MID_MONTH)


def star_watchlist(spark: SparkSession, path: str) -> DataFrame:
    """Suppliers with a high balance, listed for every region but one."""
    nations = read_table(spark, path, "nation")
    regions = read_table(spark, path, "region")
    suppliers = (
        read_table(spark, path, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return suppliers.where(
        (F.col("s_acctbal") >= WATCHED_BALANCE) & (F.col("r_name") != UNLISTED_REGION)
    ).select(F.col("r_name").alias(REGION), F.col("s_name").alias(SUPPLIER))


def watchlist(spark: SparkSession, path: str) -> DataFrame:
    return on_watchlist(supplier_spine(spark, path), star_watchlist(spark, path))


def watchlist_file(spark: SparkSession, path: str) -> DataFrame:
    """The watchlist as the job reads it: from a CSV file that another program wrote."""
    listed = star_watchlist(spark, path).select(SUPPLIER, REGION, F.lit(1).alias("note"))
    target = new_path(spark, "watchlist")
    listed.write.options(**CSV_OPTIONS).csv(target)
    return on_watchlist(supplier_spine(spark, path), read_watchlist(spark, target))


def tracking_watchlist(spark: SparkSession, path: str) -> DataFrame:
    return on_watchlist(tracking_table(spark, path), star_watchlist(spark, path))


def _scorecard(periods: ReportPeriods, mode: str) -> Query:
    def query(spark: SparkSession, path: str) -> DataFrame:
        cells = stage(report_cells(spark, path, periods, mode), "cells")
        sums = windows.scorecard_sums(cells, periods, periods.inbound_windows(mode))
        table = _tracking_from(spark, path, cells, periods)
        return scorecards.scorecard(table, sums)

    return query


scorecard = _scorecard(MID_MONTH, P.ROLLING_30)


def scorecard_display(spark: SparkSession, path: str) -> DataFrame:
    return scorecards.display(scorecard(spark, path), digits=4)


def regional_tracking(spark: SparkSession, path: str) -> DataFrame:
    """The tracking table of a full report run for some of the regions."""
    mart = star_mart(spark, path, MART_COLUMNS)
    report = run_report(mart, MID_MONTH.as_of, SOME_REGIONS, tables=["tracking"])
    return report["tracking"]


def monthly_tracking(spark: SparkSession, path: str) -> DataFrame:
    """The tracking table of the calendar-month report, counting different SKUs."""
    mart = star_mart(spark, path, MART_COLUMNS)
    options = ReportOptions(
        brand_days=P.SHORT_DAYS + 1, distinct_skus=True, calendar_months=True
    )
    report = run_report(mart, MONTH_END.as_of, options=options, tables=["tracking"])
    return report["tracking"]


def _monthly_sheet(measure: str) -> Query:
    def query(spark: SparkSession, path: str) -> DataFrame:
        span = MONTH_END.monthly_extract_span
        columns = list({CATEGORY, INVENTORY, measure})
        cells = category_cells(extract_rows(spark, path, columns, span), measure)
        return sheet_of(cells, measure, MONTH_END.calendar_windows(), span, True)

    return query


def all_matrices(spark: SparkSession, path: str) -> DataFrame:
    """The four matrices of one pivot, in long form."""
    span, measures = MID_MONTH.extract_span, (*FLOWS, *STOCKS)
    wide = stage(matrices.daily_matrices(_daily(spark, path, measures), measures, span), "matrices")
    long = [matrices.matrix_to_long(matrices.measure_matrix(wide, m, span), m) for m in measures]
    return reduce(lambda one, two: one.join(two, [*KEYS, DAY], "full"), long)


def report_order(spark: SparkSession, path: str) -> DataFrame:
    """Each supplier's place in its region's published tracking table."""
    folders = write_report({"tracking": tracking_table(spark, path)}, new_path(spark, "report"), "parquet")
    rows_there = spark.read.parquet(folders["tracking"]).select(
        *KEYS, F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    order = Window.partitionBy(REGION).orderBy("file", "row")
    return rows_there.select(*KEYS, F.row_number().over(order).alias("position"))


def report_kept_days(spark: SparkSession, path: str) -> DataFrame:
    """The scorecard of a daily run that reads the last day only, after one the day before."""
    mart, target = star_mart(spark, path, MART_COLUMNS), new_path(spark, "kept")
    before = MID_MONTH.as_of - timedelta(days=1)
    refresh(mart, target, ReportPeriods(before).extract_span)
    return daily_report(mart, target, MID_MONTH.as_of, tables=["scorecard"])["scorecard"]


def _sketched(span: Span) -> Query:
    """Different SKUs of a range of days from the sketches of its days."""

    def query(spark: SparkSession, path: str) -> DataFrame:
        sketches = snapshot.sku_sketches(extract_rows(spark, path, [SKU], span))
        return snapshot.sku_count_sketched(sketches, span)

    return query


def _report_table(name: str, options: ReportOptions = ReportOptions()) -> Query:
    """One table of a full report run for all regions, asked for by name."""

    def query(spark: SparkSession, path: str) -> DataFrame:
        mart = star_mart(spark, path, MART_COLUMNS)
        tables = run_report(mart, MID_MONTH.as_of, REGIONS, options=options, tables=[name])
        return tables[name]

    return query


QUERIES: Mapping[str, Query] = {
    "mart_extract": mart_extract,
    "extract_roundtrip": extract_roundtrip,
    "extract_roundtrip_inferred": extract_roundtrip_inferred,
    "mart_roundtrip": mart_roundtrip,
    "report_roundtrip": report_roundtrip,
    "report_in_turns": report_in_turns,
    "report_order": report_order,
    "matrix_roundtrip": matrix_roundtrip,
    "snapshot_rows": snapshot_rows,
    "trailing_rows": trailing_rows,
    "dedup_rows": dedup_rows,
    "supplier_spine": supplier_spine,
    "row_flags": row_flags,
    "period_calendar": period_calendar,
    "calendar_spine": calendar_spine,
    "period_coverage": period_coverage,
    "inv_count": _snapshot(snapshot.inventory_count, UNITS),
    "inv_value": _snapshot(snapshot.inventory_value, INVENTORY),
    "sku_count": _snapshot(snapshot.sku_count, SKU),
    "sku_count_distinct": _snapshot(snapshot.sku_count_distinct, SKU),
    "sku_count_sketched": _sketched(MID_MONTH.extract_span),
    "payment_terms": _snapshot(snapshot.payment_terms, TERMS),
    "latest_date": latest_date,
    "main_category": main_category,
    "main_category_snapshot": _snapshot(
        snapshot.main_category_snapshot, CATEGORY, INVENTORY
    ),
    "daily_totals": all_daily_totals,
    "cogs_trailing": _flow(COGS, MID_MONTH, MID_MONTH.trailing_windows()),
    "inventory_trailing": _stock(INVENTORY),
    "payables_trailing": _stock(PAYABLES),
    "inbound_trailing": _flow(INBOUND, MID_MONTH, MID_MONTH.inbound_windows()),
    "inbound_calendar": _flow(INBOUND, MONTH_END, MONTH_END.inbound_windows(CALENDAR)),
    "replenishment": _replenishment(windows.replenishment, MID_MONTH, P.ROLLING_30),
    "replenishment_calendar": _replenishment(
        windows.replenishment, MONTH_END, CALENDAR
    ),
    "green_replenishment": _replenishment(
        windows.green_replenishment, MID_MONTH, P.ROLLING_30
    ),
    "eop_inventory": eop_inventory,
    "black_stock": black_stock,
    "l30_inventory_days": l30_inventory_days,
    "monthly_flow_sums": _monthly_flows(MID_MONTH),
    "monthly_flow_sums_month_end": _monthly_flows(MONTH_END),
    "monthly_stock_means": monthly_stock_means,
    "working_capital_days": working_capital_days,
    "brand_counts": brand_counts,
    "top_brands": top_brands,
    "top_brands_ranked": top_brands_ranked,
    "top_brands_wide": top_brands_wide,
    "top_brands_ranked_wide": top_brands_ranked_wide,
    "brand_canonical": brand_canonical,
    "watchlist": watchlist,
    "watchlist_file": watchlist_file,
    "daily_cogs": _matrix(COGS),
    "daily_payables": _matrix(PAYABLES),
    "daily_inventory": _matrix(INVENTORY),
    "daily_inbound": _matrix(INBOUND),
    "all_matrices": all_matrices,
    "matrix_with_category": matrix_with_category,
    "tracking": tracking_table,
    "tracking_watchlist": tracking_watchlist,
    "scorecard": scorecard,
    "scorecard_calendar": _scorecard(MONTH_END, CALENDAR),
    "scorecard_display": scorecard_display,
    "sheet_payables": _sheet(PAYABLES),
    "sheet_cogs": _sheet(COGS),
    "sheet_inventory": _sheet(INVENTORY),
    "sheet_inbound": _sheet(INBOUND),
    "monthly_cogs_sheet": _monthly_sheet(COGS),
    "monthly_payables_sheet": _monthly_sheet(PAYABLES),
    "monthly_inventory_sheet": _monthly_sheet(INVENTORY),
    "monthly_inbound_sheet": _monthly_sheet(INBOUND),
    "regional_tracking": regional_tracking,
    "monthly_tracking": monthly_tracking,
    "report_kept_days": report_kept_days,
    "report_clean_brands": _report_table("tracking", ReportOptions(clean_brands=True)),
    "report_sku_sketches": _report_table("tracking", ReportOptions(sku_sketches=True)),
    "report_working_capital": _report_table("working_capital"),
    "report_coverage": _report_table("coverage"),
    "report_brand_ties": _report_table("tracking", ReportOptions(brand_ties=True)),
    "report_date_category": _report_table(
        "tracking", ReportOptions(category_on_report_date=True)
    ),
}


def registered() -> dict[str, Query]:
    def finished(query: Query) -> Query:
        return lambda spark, path: with_doubles(query(spark, path))

    return {name: finished(query) for name, query in QUERIES.items()}
