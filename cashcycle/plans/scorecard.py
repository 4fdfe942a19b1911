"""The supplier scorecard: tracking plus replenishment, black stock and L30 days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashcycle.functions.measures import safe_ratio
from cashcycle.functions.periods import INBOUND_PERIODS, PERIODS
from cashcycle.operators.rows import green_column, repln_column
from cashcycle.plans.tracking import TRACKING_COLUMNS
from cashcycle.schema import KEYS, NOT_AVAILABLE

LONGEST_FRACTION = 14



def scorecard(tracking: DataFrame, sums: DataFrame) -> DataFrame:
    """Tracking rows with their shares; ``sums`` comes from ``scorecard_sums``."""
    shares = {}
    for label in INBOUND_PERIODS:
        shares[f"{repln_column(label)}_perc"] = safe_ratio(
            F.col(repln_column(label)), F.col(f"inb_{label}")
        )
    for label in INBOUND_PERIODS:
        shares[f"{green_column(label)}_perc"] = safe_ratio(
            F.col(green_column(label)), F.col(repln_column(label))
        )
    black = [f"black_inv_{label}" for label in PERIODS]
    for label in PERIODS:
        shares[f"black_inv_{label}_perc"] = safe_ratio(
            F.col(f"black_inv_{label}"), F.col(f"eop_inv_{label}")
        )
    shares["l30_inv_days"] = safe_ratio(F.col("_l30_inventory"), F.col("_l30_cogs"))
    names = list(shares)
    return (
        tracking.join(sums, list(KEYS), "left")
        .withColumns(shares)
        .select(*TRACKING_COLUMNS, *names[:6], *black, *names[6:])
    )


def display(table: DataFrame, digits: int | None = None) -> DataFrame:
    """All columns as text, missing values as N/A.

    Numbers have all their digits; ``digits`` rounds them to so many decimals.
    """
    columns = []
    for field in table.schema.fields:
        value = F.col(field.name)
        number = isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType))
        if number and digits is not None:
            value = value.cast(T.DecimalType(38 - LONGEST_FRACTION + digits, digits))
        columns.append(
            F.coalesce(value.cast("string"), F.lit(NOT_AVAILABLE)).alias(field.name)
        )
    return table.select(*columns)
