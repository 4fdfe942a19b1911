"""Daily supplier x date matrices.

``daily_matrices`` pivots several measures in one grouping. Its rows hold all that the daily
sheets show: ``measure_matrix`` takes out one measure's days, and ``day_metrics`` works out
period sums and means from the days of the row, without another grouping or a join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashcycle.functions.periods import Span
from cashcycle.operators.windows import PREFIX
from cashcycle.schema import DAY, KEYS, STOCKS


def daily_matrix(daily: DataFrame, measure: str, span: Span) -> DataFrame:
    """One column per day of ``span``; NULL where the supplier has no rows.

    Several rows of a supplier and day, such as cells, are added up.

    The days are given, so Spark needs no extra job to find them, and a day on
    which nobody has rows still gets its column. Pivoting on the day itself keeps the
    partitioning of the daily totals.
    """
    days = [day.isoformat() for day in span.dates()]
    return (
        daily.where(span.contains())
        .select(*KEYS, DAY, measure)
        .groupBy(*KEYS)
        .pivot(DAY, days)
        .agg(F.sum(measure))
    )


def daily_matrices(daily: DataFrame, measures: Sequence[str], span: Span) -> DataFrame:
    """All measures in one row per supplier: an array with an entry for each day of the span,
    NULL where the supplier has no rows. ``daily`` has one row per supplier and day.

    One grouping gathers the days of a supplier, never more than the span has. Arrays keep the
    plans of what is built on them small: hundreds of pivot columns exceed what Spark compiles,
    and metrics over columns that are shown as well make its inference of constraints explode.
    """
    number = F.date_diff(F.col(DAY), F.lit(span.start)).alias("day")
    totals = F.struct(*measures).alias("totals")
    days = F.map_from_entries(F.collect_list(F.struct(number, totals))).alias("_days")
    gathered = daily.where(span.contains()).groupBy(*KEYS).agg(days)
    numbers = F.sequence(F.lit(0), F.lit(span.days - 1))
    every = F.transform(numbers, lambda n: F.try_element_at("_days", n)).alias("_every")
    return gathered.select(*KEYS, every).select(*KEYS, *[F.col("_every")[m].alias(m) for m in measures])


def day_columns(measure: str, span: Span) -> list[str]:
    """The days of a measure's array as columns, in SQL: hundreds of them are parsed sooner
    than made one by one."""
    return [f"{measure}[{n}] AS `{day}`" for n, day in enumerate(span.dates())]


def measure_matrix(wide: DataFrame, measure: str, span: Span) -> DataFrame:
    """The matrix of one measure."""
    return wide.selectExpr(*KEYS, *day_columns(measure, span))


def day_metrics(
    wide: DataFrame,
    measure: str,
    windows: Mapping[str, Span],
    span: Span,
    zero_if_none: bool = False,
) -> list[Column]:
    """Period metrics of a row's days: stocks are averaged over the days with rows, flows
    summed; missing if no day of the window has rows, or 0 with ``zero_if_none``. Windows must
    lie within the matrix."""
    kind = wide.schema[measure].dataType.elementType
    metrics = []
    for label, window in windows.items():
        if window.start < span.start or window.end > span.end:
            raise ValueError(f"the matrix does not hold all days of {label}")
        days = F.slice(measure, (window.start - span.start).days + 1, window.days)
        there = F.filter(days, lambda value: value.isNotNull())
        total = F.aggregate(there, F.lit(0).cast(kind), lambda a, b: (a + b).cast(kind))
        if measure in STOCKS:
            value = F.try_divide(total.cast("double"), F.size(there).cast("double"))
        else:
            value = total if zero_if_none else F.when(F.size(there) > 0, total)
        metrics.append(value.alias(f"{PREFIX[measure]}_{label}"))
    return metrics


def matrix_to_long(matrix: DataFrame, measure: str) -> DataFrame:
    """Back to one row per supplier and day with rows."""
    days = [name for name in matrix.columns if name[:1].isdigit()]
    return (
        matrix.unpivot(list(KEYS), days, "day", measure)
        .where(F.col(measure).isNotNull())
        .select(*KEYS, F.to_date("day").alias(DAY), measure)
    )
