"""Restricting a supplier table to a watchlist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcycle.operators.joins import join_lookup
from cashcycle.schema import KEYS, REGION


def on_watchlist(suppliers: DataFrame, watchlist: DataFrame) -> DataFrame:
    """Keep listed suppliers; a region without any list keeps all of its own."""
    listed = watchlist.select(*KEYS).distinct().withColumn("_listed", F.lit(True))
    regions = watchlist.select(REGION).distinct().withColumn("_has_list", F.lit(True))
    marked = join_lookup(suppliers, regions, [REGION])
    marked = marked.join(listed, list(KEYS), "left")
    return marked.where(F.col("_listed") | F.col("_has_list").isNull()).select(
        *suppliers.columns
    )
