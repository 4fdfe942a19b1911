"""Supplier-day cells: the one pass over the mart that a whole report needs.

``supplier_day_cells`` are those of one report date. ``base_cells`` have a finer grain from which
``cells_from_base`` makes the cells of any report date, so they can be kept day by day.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcycle.functions.measures import flag, masked, zero_if_missing
from cashcycle.functions.money import to_whole, total, whole_types
from cashcycle.functions.periods import Span
from cashcycle.operators.rows import (
    BLACK_INVENTORY,
    N_ROWS,
    SKU_ROWS,
    green_column,
    repln_column,
    with_additive_measures,
)
from cashcycle.schema import (
    BLACK,
    CATEGORY,
    COLOR,
    CREATED,
    DAY,
    GREEN,
    INBOUND,
    INVENTORY,
    KEYS,
    MEASURES,
    SKU,
    TERMS,
)

AGE = "sku_age"
#: No inbound window is longer.
MOST_AGE = 31


def supplier_day_cells(
    rows: DataFrame, as_of: date, windows: Mapping[str, Span]
) -> DataFrame:
    """Extract rows summed per region, supplier, day and category.

    Everything in the report except the brand ranking follows from these cells.
    Their number is bounded by suppliers x days x categories, whatever the number
    of SKUs, and each task combines its rows before the shuffle, so a dominant
    supplier sends a handful of rows per task. Payment terms are part of the key
    on the report date only, the one day they are reported for; grouping by them
    instead of taking a string minimum keeps this a hash aggregation.
    """
    terms = F.when(F.col(DAY) == F.lit(as_of), F.col(TERMS)).alias(TERMS)
    sources = {name: name for name in MEASURES}
    sources |= {SKU_ROWS: SKU_ROWS, BLACK_INVENTORY: INVENTORY}
    for label in windows:
        sources |= {repln_column(label): INBOUND, green_column(label): INBOUND}
    whole = whole_types(rows, MEASURES)
    return (
        with_additive_measures(to_whole(rows, whole), windows)
        .groupBy(*KEYS, DAY, CATEGORY, terms)
        .agg(
            *[
                total(F.col(name), whole.get(source)).alias(name)
                for name, source in sources.items()
            ],
            F.count("*").alias(N_ROWS),
        )
    )


def base_cells(rows: DataFrame) -> DataFrame:
    """Extract rows summed so that they serve any report date.

    What depends on the date are payment terms and the two masks. Terms are part of the key on
    all days. Replenishment asks whether a SKU is older than its window's start, which on a day
    of the window is a question of its age on that day, up to ``MOST_AGE`` days; black and green
    are a matter of colour. Age and colour thus join the key, with few values each: most
    SKUs are older than ``MOST_AGE`` days.
    """
    whole = whole_types(rows, MEASURES)
    measured = to_whole(rows, whole).withColumns(
        {
            **{name: zero_if_missing(name) for name in MEASURES},
            SKU_ROWS: flag(F.col(SKU).isNotNull()),
            AGE: F.least(F.greatest(F.date_diff(DAY, CREATED), F.lit(0)), F.lit(MOST_AGE)),
            COLOR: F.when(F.col(COLOR).isin(GREEN, BLACK), F.col(COLOR)),
        }
    )
    # least and greatest skip missing values: a SKU without date has no age.
    measured = measured.withColumn(AGE, F.when(F.col(CREATED).isNotNull(), F.col(AGE)))
    return measured.groupBy(*KEYS, DAY, CATEGORY, TERMS, AGE, COLOR).agg(
        *[total(F.col(name), whole.get(name)).alias(name) for name in (*MEASURES, SKU_ROWS)],
        F.count("*").alias(N_ROWS),
    )


def cells_from_base(
    base: DataFrame, as_of: date, windows: Mapping[str, Span]
) -> DataFrame:
    """The supplier-day cells of a report date; replenishment is 0 outside its window."""
    kinds = {field.name: field.dataType for field in base.schema.fields}
    masked_by = {BLACK_INVENTORY: (F.col(COLOR) == BLACK, INVENTORY)}
    for label, window in windows.items():
        if window.days > MOST_AGE:
            raise ValueError(f"{label} is longer than the {MOST_AGE} days that base cells tell apart")
        old = window.contains() & (F.col(AGE) > F.date_diff(F.col(DAY), F.lit(window.start)))
        masked_by[repln_column(label)] = (old, INBOUND)
        masked_by[green_column(label)] = (old & (F.col(COLOR) == GREEN), INBOUND)
    values = {name: (F.col(name), name) for name in (*MEASURES, SKU_ROWS)}
    values |= {name: (masked(when, m), m) for name, (when, m) in masked_by.items()}
    terms = F.when(F.col(DAY) == F.lit(as_of), F.col(TERMS)).alias(TERMS)
    return base.groupBy(*KEYS, DAY, CATEGORY, terms).agg(
        *[total(v).cast(kinds[m]).alias(name) for name, (v, m) in values.items()],
        F.sum(N_ROWS).alias(N_ROWS),
    )


def daily_totals(
    cells: DataFrame, measures: tuple[str, ...] = MEASURES, by: tuple[str, ...] = ()
) -> DataFrame:
    """Supplier totals per day, the long form of the daily matrices.

    ``by`` adds further columns to the grouping.
    """
    whole = whole_types(cells, measures)
    return (
        to_whole(cells, whole)
        .groupBy(*KEYS, DAY, *by)
        .agg(
            *[
                total(zero_if_missing(name), whole.get(name)).alias(name)
                for name in measures
            ]
        )
    )
