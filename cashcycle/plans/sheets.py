"""The four daily sheets: category, period metrics, then one column per day."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from cashcycle.functions.periods import Span
from cashcycle.operators.matrices import day_columns, day_metrics, measure_matrix
from cashcycle.schema import CATEGORY, KEYS, REGION, SUPPLIER


def with_category(table: DataFrame, categories: DataFrame) -> DataFrame:
    """Put the main category in front; suppliers without one keep their row."""
    front = (REGION, CATEGORY, SUPPLIER)
    return table.join(categories, list(KEYS), "left").selectExpr(
        *front, f"* EXCEPT ({', '.join(front)})"
    )


def matrix_table(
    wide: DataFrame, categories: DataFrame, measure: str, span: Span
) -> DataFrame:
    """One measure's days; ``wide`` comes from ``daily_matrices``."""
    return with_category(measure_matrix(wide, measure, span), categories)


def sheet(
    wide: DataFrame,
    categories: DataFrame,
    measure: str,
    windows: Mapping[str, Span],
    span: Span,
    zero_if_none: bool = False,
) -> DataFrame:
    """Period metrics beside the days they are worked out from, of the same row."""
    metrics = day_metrics(wide, measure, windows, span, zero_if_none)
    names = wide.select(*metrics).columns
    rows = wide.select("*", *metrics).selectExpr(*KEYS, *names, *day_columns(measure, span))
    return with_category(rows, categories)
