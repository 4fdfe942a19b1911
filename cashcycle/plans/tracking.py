"""The tracking table: one row per supplier present on the report date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcycle.functions.periods import Span
from cashcycle.operators.brands import (
    TOP_BRANDS,
    brand_counts,
    top_brands,
    top_brands_ranked,
    top_brands_wide,
)
from cashcycle.operators.rows import SKU_ROWS
from cashcycle.operators.snapshot import (
    SKU_COUNT,
    UNIT_COUNT,
    main_category,
    snapshot_totals,
)
from cashcycle.schema import (
    CATEGORY,
    DAY,
    INVENTORY,
    KEYS,
    NO_BRAND,
    SUPPLIER,
    TERMS,
    UNITS,
)

BRAND_COLUMNS = tuple(f"brand_{place}" for place in range(1, TOP_BRANDS + 1))
TRACKING_COLUMNS = (
    KEYS[0],
    CATEGORY,
    SUPPLIER,
    SKU_COUNT,
    UNIT_COUNT,
    INVENTORY,
    *BRAND_COLUMNS,
    TERMS,
)
#: What the tracking table needs of the supplier-day cells.
TRACKING_CELLS = (*KEYS, DAY, CATEGORY, TERMS, SKU_ROWS, UNITS, INVENTORY)


def supplier_brands(rows: DataFrame, span: Span, ties: bool = False) -> DataFrame:
    """The top brands of each supplier in columns."""
    return ranked_brands(brand_counts(rows, span), ties)


def ranked_brands(counts: DataFrame, ties: bool = False) -> DataFrame:
    """The top brands from their counts.

    With ``ties``, brands with equal counts share a rank, and the first three of all brands
    of rank three or better fill the places, those of a rank in text order.
    """
    rank = top_brands_ranked if ties else top_brands
    return top_brands_wide(rank(counts))


def tracking(
    cells: DataFrame,
    brands: DataFrame,
    as_of: date,
    categories: DataFrame | None = None,
    sku_counts: DataFrame | None = None,
) -> DataFrame:
    """Category, SKUs, units, value, brands and terms per supplier.

    ``categories`` and ``sku_counts`` replace the defaults (category on the
    supplier's latest day; SKU rows on the report date).
    """
    table = snapshot_totals(cells, as_of)
    if sku_counts is not None:
        table = table.drop(SKU_COUNT).join(sku_counts, list(KEYS), "left")
    if categories is None:
        categories = main_category(cells)
    table = table.join(categories, list(KEYS), "left").join(brands, list(KEYS), "left")
    return table.withColumns(
        {name: F.coalesce(name, F.lit(NO_BRAND)) for name in BRAND_COLUMNS}
    ).select(*TRACKING_COLUMNS)
