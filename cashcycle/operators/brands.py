"""Brand ranking and brand-name clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cashcycle.functions.periods import Span
from cashcycle.operators.joins import join_lookup
from cashcycle.operators.rows import distinct_rows, rows_in
from cashcycle.schema import BRAND, DAY, KEYS, MISSING_BRAND_TEXT, NO_BRAND

TOP_BRANDS = 3


def brand_counts(rows: DataFrame, span: Span) -> DataFrame:
    """Distinct extract rows per supplier and brand within a range of days."""
    branded = rows_in(rows, span).where(
        F.col(BRAND).isNotNull() & (F.col(BRAND) != MISSING_BRAND_TEXT)
    )
    return distinct_rows(branded).groupBy(*KEYS, BRAND).agg(F.count("*").alias("n"))


def brand_day_counts(rows: DataFrame) -> DataFrame:
    """As ``brand_counts`` for each day. Rows of two days differ in the day, so the counts of
    a range of days are the sums of its days' counts."""
    branded = rows.where(F.col(BRAND).isNotNull() & (F.col(BRAND) != MISSING_BRAND_TEXT))
    return distinct_rows(branded).groupBy(*KEYS, DAY, BRAND).agg(F.count("*").alias("n"))


def sum_of_days(counts: DataFrame, span: Span) -> DataFrame:
    """Brand counts of a range of days from those of its days."""
    return rows_in(counts, span).groupBy(*KEYS, BRAND).agg(F.sum("n").alias("n"))


def top_brands(counts: DataFrame, k: int = TOP_BRANDS) -> DataFrame:
    """The ``k`` most frequent brands of each supplier, ties in text order."""
    order = Window.partitionBy(*KEYS).orderBy(F.col("n").desc(), F.col(BRAND))
    return counts.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= k
    )


def top_brands_ranked(counts: DataFrame, k: int = TOP_BRANDS) -> DataFrame:
    """Brands of rank ``k`` or better; brands with equal counts share a rank."""
    order = Window.partitionBy(*KEYS).orderBy(F.col("n").desc())
    return counts.withColumn("rank", F.rank().over(order)).where(F.col("rank") <= k)


def top_brands_wide(top: DataFrame, k: int = TOP_BRANDS) -> DataFrame:
    """One row per supplier with ``brand_1`` to ``brand_k``.

    The places are filled in order of rank, brands that share a rank in text order. What
    is behind place ``k`` is cut before it is gathered, so an array never has more than ``k``
    brands, whatever the number of brands that share a rank.
    """
    order = Window.partitionBy(*KEYS).orderBy("rank", BRAND)
    first = top.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k)
    places = F.array_sort(F.collect_list(F.struct("_place", BRAND))).alias("_brands")
    ordered = first.groupBy(*KEYS).agg(places)
    return ordered.select(
        *KEYS,
        *[
            F.coalesce(F.get("_brands", F.lit(place))[BRAND], F.lit(NO_BRAND)).alias(f"brand_{place + 1}")
            for place in range(k)
        ],
    )


def brand_spellings(rows: DataFrame) -> DataFrame:
    """Blank-free brand names that also occur with blanks: brand -> spaced name.

    Of several spaced spellings the last in text order is taken.
    """
    names = rows.select(BRAND).where(F.col(BRAND).isNotNull()).distinct()
    compact = F.replace(F.col(BRAND), F.lit(" "), F.lit(""))
    spaced = F.when(F.col(BRAND) != compact, F.col(BRAND))
    return (
        names.groupBy(compact.alias(BRAND))
        .agg(F.count("*").alias("n"), F.max(spaced).alias("spaced"))
        .where((F.col("n") > 1) & F.col("spaced").isNotNull())
        .select(BRAND, "spaced")
    )


def canonical_brands(rows: DataFrame) -> DataFrame:
    """Rename each blank-free brand to its spaced spelling where one occurs."""
    joined = join_lookup(rows, brand_spellings(rows), [BRAND])
    return joined.withColumn(BRAND, F.coalesce("spaced", BRAND)).select(*rows.columns)
