"""Row-level filters, de-duplication and flags."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashcycle.functions.measures import flag, masked, zero_if_missing
from cashcycle.functions.periods import Span
from cashcycle.schema import (
    BLACK,
    COLOR,
    CREATED,
    DAY,
    GREEN,
    INBOUND,
    INVENTORY,
    KEYS,
    MEASURES,
    SKU,
)

SKU_ROWS = "sku_rows"
N_ROWS = "n_rows"
BLACK_INVENTORY = "black_inv_usd"


def snapshot_rows(rows: DataFrame, as_of: date) -> DataFrame:
    return rows.where(F.col(DAY) == F.lit(as_of))


def rows_in(rows: DataFrame, span: Span) -> DataFrame:
    return rows.where(span.contains())


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Rows that differ in at least one column.

    Copies collapse before the shuffle, which hashes on every column: a large
    group of copies costs one row per task.
    """
    return rows.dropDuplicates()


def supplier_spine(rows: DataFrame) -> DataFrame:
    return rows.select(*KEYS).distinct()


def is_replenishment(window: Span) -> Column:
    """The SKU existed before the window began."""
    return F.col(CREATED) < F.lit(window.start)


def is_green_replenishment(window: Span) -> Column:
    return is_replenishment(window) & (F.col(COLOR) == GREEN)


def is_black() -> Column:
    return F.col(COLOR) == BLACK


def repln_column(label: str) -> str:
    return f"inb_repln_{label}"


def green_column(label: str) -> str:
    return f"green_repln_{label}"


def row_flags(rows: DataFrame, windows: Mapping[str, Span]) -> DataFrame:
    """Each row with its 0/1 flags and the measures they mask, per inbound window."""
    flags = {"is_black_inv": flag(is_black())}
    for label, window in windows.items():
        inside = window.contains()
        flags[f"is_replenishment_{label}"] = flag(inside & is_replenishment(window))
        flags[f"is_green_repln_{label}"] = flag(
            inside & is_green_replenishment(window)
        )
    return with_black_inventory(with_replenishment(rows.withColumns(flags), windows))


def with_replenishment(rows: DataFrame, windows: Mapping[str, Span]) -> DataFrame:
    """Add the replenishment and green replenishment part of the inbound value.

    They are masked by creation date and colour alone; the window itself is applied
    when the column is summed, which keeps "no rows" apart from "0".
    """
    added = {}
    for label, window in windows.items():
        added[repln_column(label)] = masked(is_replenishment(window), INBOUND)
        added[green_column(label)] = masked(is_green_replenishment(window), INBOUND)
    return rows.withColumns(added)


def with_black_inventory(rows: DataFrame) -> DataFrame:
    return rows.withColumn(BLACK_INVENTORY, masked(is_black(), INVENTORY))


def with_additive_measures(rows: DataFrame, windows: Mapping[str, Span]) -> DataFrame:
    """Everything a report sums, as columns without missing values."""
    measured = with_black_inventory(with_replenishment(rows, windows))
    return measured.withColumns(
        {
            SKU_ROWS: flag(F.col(SKU).isNotNull()),
            **{name: zero_if_missing(name) for name in MEASURES},
        }
    )
