"""Coverage checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcycle.functions.periods import ReportPeriods, Span
from cashcycle.operators.rows import N_ROWS
from cashcycle.schema import DAY, KEYS, REGION


def period_coverage(
    rows: DataFrame, periods: ReportPeriods, regions: Iterable[str] | None = None
) -> DataFrame:
    """For every region and period end, how many rows there are and whether any.

    ``rows`` are extract rows, or cells, which carry the number of their rows. Of
    ``regions``, if given, those without any row are listed too, with 0 rows.
    """
    n = F.col(N_ROWS) if N_ROWS in rows.columns else F.lit(1)
    counts = rows.groupBy(REGION).agg(
        *[
            F.sum(F.when(F.col(DAY) == F.lit(end), n).otherwise(0)).alias(label)
            for label, end in periods.ends.items()
        ]
    )
    if regions is not None:
        asked = rows.sparkSession.createDataFrame(
            [(name,) for name in sorted(set(regions))], f"{REGION} string"
        )
        counts = asked.join(counts, REGION, "left").fillna(0)
    end_of = F.create_map(
        *[part for label, end in periods.ends.items() for part in (F.lit(label), F.lit(end))]
    )
    return counts.unpivot(
        [REGION], list(periods.ends), "period", "n_rows"
    ).withColumns({"period_end": end_of[F.col("period")], "has_data": F.col("n_rows") > 0})


def calendar_spine(rows: DataFrame, span: Span) -> DataFrame:
    """Every date of the span with the number of suppliers that have rows on it.

    The day counts are one row per date, so the join side is bounded by the span.
    """
    spark = rows.sparkSession
    spine = spark.range(1).select(
        F.explode(F.sequence(F.lit(span.start), F.lit(span.end))).alias(DAY)
    )
    suppliers = (
        rows.where(span.contains())
        .select(*KEYS, DAY)
        .distinct()
        .groupBy(DAY)
        .agg(F.count("*").alias("n_suppliers"))
    )
    return spine.join(suppliers, DAY, "left").select(
        DAY, F.coalesce("n_suppliers", F.lit(0)).alias("n_suppliers")
    )
