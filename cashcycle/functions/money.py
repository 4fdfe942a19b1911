"""Exact sums of decimals, whatever their number and size.

Spark adds decimals beyond 18 digits as arbitrary-precision numbers: summing rows of
``DECIMAL(18,4)`` that way takes about three times as long as summing whole numbers.
Measures of up to 18 digits are therefore turned into units of their last decimal
place and summed in two parts, the upper and the lower 30 bits of each. A part of a
row is below 2**30, so a group may have 2**33 rows of any size before a part could
overflow. The total has ten digits more than the measure, in every session.

Wider decimals use Spark's own sums. Where such a sum overflows, Spark returns NULL
unless the session is in ANSI mode; ``total`` raises an error in both.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG_DIGITS = 18
MORE_DIGITS = 10
PART_BITS = 30


def whole_types(rows: DataFrame, measures: Iterable[str]) -> dict[str, T.DecimalType]:
    """The measures that can be summed as whole numbers, with their types."""
    types = {field.name: field.dataType for field in rows.schema.fields}
    return {
        name: types[name]
        for name in measures
        if isinstance(types[name], T.DecimalType) and types[name].precision <= LONG_DIGITS
    }


def to_whole(rows: DataFrame, types: Mapping[str, T.DecimalType]) -> DataFrame:
    return rows.withColumns(
        {name: (F.col(name) * 10**kind.scale).cast("bigint") for name, kind in types.items()}
    )


def total(value: Column, whole: T.DecimalType | None = None) -> Column:
    """The sum of ``value``; ``whole`` is the type it had before ``to_whole``."""
    if whole is None:
        added = F.sum(value)
        lost = F.raise_error(F.lit("a total has more digits than a decimal can hold"))
        return F.coalesce(added, F.when(F.count(value) > 0, lost))
    value = value.cast("bigint")
    upper = F.sum(F.shiftright(value, PART_BITS)).cast("decimal(20,0)")
    lower = F.sum(value.bitwiseAND(F.lit((1 << PART_BITS) - 1).cast("bigint")))
    units = upper * F.lit(Decimal(1 << PART_BITS)) + lower.cast("decimal(20,0)")
    scaled = units * F.lit(Decimal(1).scaleb(-whole.scale))
    return scaled.cast(T.DecimalType(whole.precision + MORE_DIGITS, whole.scale))
