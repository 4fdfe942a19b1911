"""Measure expressions with the report's missing-value rules.

* A missing value counts as 0 inside a sum, but a window without any row stays
  NULL: the zero goes into the *input* of the sum, never around it.
* A mean is taken over the days that have rows; absent days are not zeros.
* A ratio with a zero or missing denominator is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cashcycle.functions.money import total
from cashcycle.functions.periods import Span


def zero_if_missing(measure: Column | str) -> Column:
    measure = F.col(measure) if isinstance(measure, str) else measure
    return F.coalesce(measure, F.lit(0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def masked(condition: Column, measure: Column | str) -> Column:
    """The measure where the condition holds, otherwise 0."""
    return F.when(condition, zero_if_missing(measure)).otherwise(0)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def in_window(span: Span, measure: str) -> Column:
    """The measure in a window, 0 where it is missing; NULL outside."""
    return F.when(span.contains(), zero_if_missing(measure))


def sum_in(span: Span, measure: str) -> Column:
    """Sum over the rows of a window; NULL if the window has no row."""
    return total(in_window(span, measure))


def mean_in(span: Span, measure: str) -> Column:
    """Mean over the rows of a window; NULL if the window has no row.

    Written as sum over count so that exact decimals stay exact up to the one
    division.
    """
    value = F.when(span.contains(), F.col(measure))
    return F.try_divide(total(value).cast("double"), F.count(value).cast("double"))
