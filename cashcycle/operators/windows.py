"""Trailing-window and calendar-month metrics per supplier.

All windows of a table are conditional aggregates of one grouping.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashcycle.functions.measures import in_window, mean_in, safe_ratio, sum_in
from cashcycle.functions.money import to_whole, total, whole_types
from cashcycle.functions.periods import ReportPeriods, Span
from cashcycle.operators.rows import BLACK_INVENTORY, green_column, repln_column
from cashcycle.schema import (
    COGS,
    DAY,
    FLOWS,
    INBOUND,
    INVENTORY,
    KEYS,
    PAYABLES,
    STOCKS,
)

# Column prefixes of the period metrics.
PREFIX = {COGS: "cogs", INBOUND: "inb", INVENTORY: "inv", PAYABLES: "payable"}


def window_sums(rows: DataFrame, sums: Mapping[str, tuple[str, Span]]) -> DataFrame:
    """Sums per supplier: output name -> (measure, window). Rows may be of any grain."""
    whole = whole_types(rows, {measure for measure, _ in sums.values()})
    return (
        to_whole(rows, whole)
        .groupBy(*KEYS)
        .agg(
            *[
                total(in_window(span, m), whole.get(m)).alias(name)
                for name, (m, span) in sums.items()
            ]
        )
    )


def period_sums(
    rows: DataFrame, measure: str, windows: Mapping[str, Span]
) -> DataFrame:
    prefix = PREFIX[measure]
    return window_sums(
        rows, {f"{prefix}_{label}": (measure, span) for label, span in windows.items()}
    )


def period_means(
    daily: DataFrame, measure: str, windows: Mapping[str, Span]
) -> DataFrame:
    """Means of the daily totals; ``daily`` must have one row per supplier and day."""
    return daily.groupBy(*KEYS).agg(
        *[
            mean_in(span, measure).alias(f"{PREFIX[measure]}_{label}")
            for label, span in windows.items()
        ]
    )


def period_metrics(
    daily: DataFrame, measure: str, windows: Mapping[str, Span]
) -> DataFrame:
    """Stocks are averaged over a window, flows are summed."""
    summarise = period_means if measure in STOCKS else period_sums
    return summarise(daily, measure, windows)


def replenishment(measured: DataFrame, windows: Mapping[str, Span]) -> DataFrame:
    """Inbound value of SKUs created before each window."""
    return window_sums(
        measured, {repln_column(k): (repln_column(k), w) for k, w in windows.items()}
    )


def green_replenishment(measured: DataFrame, windows: Mapping[str, Span]) -> DataFrame:
    """The green part of replenishment."""
    return window_sums(
        measured, {green_column(k): (green_column(k), w) for k, w in windows.items()}
    )


def _on_ends(
    name: str, measure: str, periods: ReportPeriods
) -> dict[str, tuple[str, Span]]:
    return {f"{name}_{k}": (measure, Span(d, d)) for k, d in periods.ends.items()}


def eop_inventory(rows: DataFrame, periods: ReportPeriods) -> DataFrame:
    """Inventory value on each period end."""
    ends = rows.where(_is_period_end(periods))
    return window_sums(ends, _on_ends("eop_inv", INVENTORY, periods))


def black_stock(measured: DataFrame, periods: ReportPeriods) -> DataFrame:
    """Black inventory value on each period end."""
    ends = measured.where(_is_period_end(periods))
    return window_sums(ends, _on_ends("black_inv", BLACK_INVENTORY, periods))


def _is_period_end(periods: ReportPeriods) -> Column:
    """Single equalities, which reach the files; a list of cast dates would not."""
    return reduce(or_, (F.col(DAY) == F.lit(end) for end in periods.ends.values()))


def l30_inventory_days(rows: DataFrame, periods: ReportPeriods) -> DataFrame:
    """Inventory over COGS in the 30 days to the last completed month end."""
    span = periods.last_month_30d()
    totals = window_sums(
        rows.where(span.contains()),
        {INVENTORY: (INVENTORY, span), COGS: (COGS, span)},
    )
    return totals.select(
        *KEYS, safe_ratio(F.col(INVENTORY), F.col(COGS)).alias("l30_inv_days")
    )


def scorecard_sums(
    cells: DataFrame, periods: ReportPeriods, windows: Mapping[str, Span]
) -> DataFrame:
    """All sums behind the scorecard in one grouping."""
    last_month = periods.last_month_30d()
    sums = {f"inb_{k}": (INBOUND, w) for k, w in windows.items()}
    sums |= {repln_column(k): (repln_column(k), w) for k, w in windows.items()}
    sums |= {green_column(k): (green_column(k), w) for k, w in windows.items()}
    sums |= _on_ends("eop_inv", INVENTORY, periods)
    sums |= _on_ends("black_inv", BLACK_INVENTORY, periods)
    sums |= {
        "_l30_inventory": (INVENTORY, last_month),
        "_l30_cogs": (COGS, last_month),
    }
    return window_sums(cells, sums)


def calendar_metrics(
    daily: DataFrame, measure: str, periods: ReportPeriods
) -> DataFrame:
    """Calendar-month metrics: a flow without rows in a period sums to 0."""
    metrics = period_metrics(daily, measure, periods.calendar_windows())
    return metrics if measure in STOCKS else metrics.fillna(0)


def monthly_flow_sums(rows: DataFrame, periods: ReportPeriods) -> DataFrame:
    """COGS and inbound per calendar period; a period without rows sums to 0."""
    return window_sums(
        rows,
        {
            f"{PREFIX[measure]}_{label}": (measure, span)
            for measure in FLOWS
            for label, span in periods.calendar_windows().items()
        },
    ).fillna(0)


def monthly_stock_means(daily: DataFrame, periods: ReportPeriods) -> DataFrame:
    """Mean inventory and payables per calendar period, over the days with rows."""
    return daily.groupBy(*KEYS).agg(
        *[
            mean_in(span, measure).alias(f"{PREFIX[measure]}_{label}")
            for measure in STOCKS
            for label, span in periods.calendar_windows().items()
        ]
    )


def working_capital_days(daily: DataFrame, periods: ReportPeriods) -> DataFrame:
    """Inventory days, payable days and their difference for every window."""
    windows = periods.trailing_windows()
    totals = daily.groupBy(*KEYS).agg(
        *[sum_in(w, COGS).alias(f"cogs_{k}") for k, w in windows.items()],
        *[mean_in(w, INVENTORY).alias(f"inv_{k}") for k, w in windows.items()],
        *[mean_in(w, PAYABLES).alias(f"payable_{k}") for k, w in windows.items()],
    )
    days = {
        f"{stock}_days_{label}": safe_ratio(
            F.col(f"{stock}_{label}"), F.col(f"cogs_{label}")
        )
        * F.lit(window.days)
        for label, window in windows.items()
        for stock in ("inv", "payable")
    }
    totals = totals.select(*KEYS, *[c.alias(name) for name, c in days.items()])
    return totals.withColumns(
        {
            f"wc_days_{k}": F.col(f"inv_days_{k}") - F.col(f"payable_days_{k}")
            for k in windows
        }
    )
