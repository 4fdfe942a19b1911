"""Watchlists: the suppliers a region wants to see.

A watchlist is a table ``(grass_region, supplier_name)``. A region that is not in
it is not filtered; a region listed with a NULL supplier lets nobody pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cashcycle.schema import REGION, SUPPLIER
from cashcycle.sources.mart import read_csv

WATCHLIST_SCHEMA = T.StructType(
    [T.StructField(REGION, T.StringType()), T.StructField(SUPPLIER, T.StringType())]
)


def watchlist_from_mapping(
    spark: SparkSession, mapping: Mapping[str, Iterable[str] | None]
) -> DataFrame:
    """A watchlist from ``{region: [supplier, ...]}``; ``None`` means not filtered."""
    rows = [
        (str(region), supplier)
        for region, suppliers in mapping.items()
        if suppliers is not None
        for supplier in (list(suppliers) or [None])
    ]
    return spark.createDataFrame(rows, WATCHLIST_SCHEMA)


def read_watchlist(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, WATCHLIST_SCHEMA)
    return spark.read.schema(WATCHLIST_SCHEMA).format(fmt).load(path)


def read_watchlist_yaml(spark: SparkSession, path: str) -> DataFrame:
    """A watchlist from a YAML file of region -> list of suppliers."""
    try:
        import yaml
    except ImportError as error:
        raise ImportError("reading YAML watchlists needs PyYAML") from error
    with open(path, encoding="utf-8") as stream:
        return watchlist_from_mapping(spark, yaml.safe_load(stream) or {})
