"""Supplier figures on the report date and each supplier's main category."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cashcycle.functions.money import total
from cashcycle.functions.periods import Span
from cashcycle.operators.cells import daily_totals
from cashcycle.operators.rows import SKU_ROWS, snapshot_rows
from cashcycle.operators.windows import window_sums
from cashcycle.schema import CATEGORY, DAY, INVENTORY, KEYS, SKU, TERMS, UNITS

SKU_COUNT = "no_skus_WH"
UNIT_COUNT = "inv_count"
SKETCH = "sku_sketch"
SKETCH_LG_K = 12


def inventory_count(rows: DataFrame, as_of: date) -> DataFrame:
    return _snapshot_sum(rows, as_of, UNITS, UNIT_COUNT)


def inventory_value(rows: DataFrame, as_of: date) -> DataFrame:
    return _snapshot_sum(rows, as_of, INVENTORY, INVENTORY)


def _snapshot_sum(rows: DataFrame, as_of: date, measure: str, name: str) -> DataFrame:
    on_date = Span(as_of, as_of)
    return window_sums(snapshot_rows(rows, as_of), {name: (measure, on_date)})


def sku_count(rows: DataFrame, as_of: date) -> DataFrame:
    """Rows with a SKU on the report date."""
    return snapshot_rows(rows, as_of).groupBy(*KEYS).agg(F.count(SKU).alias(SKU_COUNT))


def sku_count_distinct(rows: DataFrame, as_of: date) -> DataFrame:
    """Different SKUs on the report date; Spark spreads a supplier by SKU first."""
    return (
        snapshot_rows(rows, as_of)
        .groupBy(*KEYS)
        .agg(F.count_distinct(SKU).alias(SKU_COUNT))
    )


def sku_sketches(rows: DataFrame, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """A HyperLogLog sketch of each supplier's SKUs on each day.

    Sketches merge: those of several days, or of parts of a supplier's rows, give the number
    of different SKUs in all of them without the rows, from at most ``2**lg_k`` bytes each. The
    relative error is about ``1.04 / 2**(lg_k / 2)``: 1.6 % at 12; small sets are exact.
    """
    return rows.groupBy(*KEYS, DAY).agg(F.hll_sketch_agg(SKU, lg_k).alias(SKETCH))


def sku_count_sketched(sketches: DataFrame, span: Span) -> DataFrame:
    """Different SKUs of each supplier in a range of days, estimated from sketches."""
    merged = F.hll_sketch_estimate(F.hll_union_agg(SKETCH))
    return sketches.where(span.contains()).groupBy(*KEYS).agg(merged.alias(SKU_COUNT))


def payment_terms(rows: DataFrame, as_of: date) -> DataFrame:
    """One of the supplier's terms on the report date: the first in text order."""
    terms = snapshot_rows(rows, as_of).select(*KEYS, TERMS).distinct()
    return terms.groupBy(*KEYS).agg(F.min(TERMS).alias(TERMS))


def snapshot_totals(cells: DataFrame, as_of: date) -> DataFrame:
    """SKU rows, units, inventory value and terms of every supplier on the date.

    Summed per payment term first, so that the text minimum, which Spark can only
    do by sorting, sees a few rows per supplier.
    """
    by_terms = (
        snapshot_rows(cells, as_of)
        .groupBy(*KEYS, TERMS)
        .agg(*[total(F.col(name)).alias(name) for name in (SKU_ROWS, UNITS, INVENTORY)])
    )
    return by_terms.groupBy(*KEYS).agg(
        F.sum(SKU_ROWS).alias(SKU_COUNT),
        F.sum(UNITS).alias(UNIT_COUNT),
        total(F.col(INVENTORY)).alias(INVENTORY),
        F.min(TERMS).alias(TERMS),
    )


def latest_date(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.max(DAY).alias(DAY))


def main_category(cells: DataFrame) -> DataFrame:
    """The category with most inventory value on the supplier's own latest day.

    Ties go to the first category in text order. Rows without category still
    decide which day is the latest, but are never chosen. One ranking over summed
    cells replaces a join of the latest days with the mart, and Spark keeps only
    the best row per supplier and task before it shuffles for the ranking.
    """
    totals = daily_totals(cells, (INVENTORY,), by=(CATEGORY,))
    best_first = Window.partitionBy(*KEYS).orderBy(
        F.col(DAY).desc(),
        F.col(CATEGORY).isNull(),
        F.col(INVENTORY).desc(),
        F.col(CATEGORY),
    )
    return (
        totals.withColumn("_rank", F.row_number().over(best_first))
        .where((F.col("_rank") == 1) & F.col(CATEGORY).isNotNull())
        .select(CATEGORY, *KEYS)
    )


def main_category_snapshot(cells: DataFrame, as_of: date) -> DataFrame:
    """As :func:`main_category`, on the report date only."""
    return main_category(snapshot_rows(cells, as_of))
