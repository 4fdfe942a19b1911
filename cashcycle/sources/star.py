"""The mart as a view over a sales star schema.

``lineitem`` is the fact table. Every line has its supplier, part and order, so a
dimension that contributes no requested column is not joined at all: asking for
fewer columns saves whole joins, which the optimizer cannot drop by itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cashcycle.schema import (
    BLACK,
    BRAND,
    CATEGORY,
    COGS,
    COLOR,
    CREATED,
    DAY,
    GREEN,
    INBOUND,
    INVENTORY,
    MART_COLUMNS,
    MONEY,
    OUTRIGHT,
    PAYABLES,
    PURCHASE_TYPE,
    REGION,
    SKU,
    SUPPLIER,
    TERMS,
    UNITS,
)


# The star tables' columns that the mart uses.
STAR_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A star table with a declared schema, which saves a job to infer it."""
    return spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{path}/{name}.parquet")


def _mart_columns() -> dict[str, tuple[tuple[str, ...], Column]]:
    """Mart column -> (dimensions it needs, expression)."""
    c = F.col
    price = c("l_extendedprice")
    return {
        REGION: (("supplier", "nation", "region"), c("r_name")),
        SUPPLIER: (("supplier",), c("s_name")),
        CATEGORY: (("part",), c("p_type")),
        BRAND: (("part",), c("p_brand")),
        SKU: ((), c("l_partkey").cast("string")),
        DAY: ((), c("l_shipdate").cast("date")),
        CREATED: (("orders",), c("o_orderdate").cast("date")),
        COLOR: (
            ("part",),
            F.when(c("p_size") <= 20, GREEN)
            .when(c("p_size") > 40, BLACK)
            .otherwise("Yellow"),
        ),
        COGS: ((), (price * (1 - c("l_discount"))).cast(MONEY)),
        UNITS: ((), c("l_quantity").cast("int")),
        INBOUND: (
            (),
            F.when(c("l_returnflag") == "N", price).otherwise(0.0).cast(MONEY),
        ),
        PAYABLES: (
            (),
            F.when(c("l_linestatus") == "O", price * (1 + c("l_tax")))
            .otherwise(0.0)
            .cast(MONEY),
        ),
        INVENTORY: (("part",), (c("l_quantity") * c("p_retailprice")).cast(MONEY)),
        TERMS: (("orders",), c("o_orderpriority")),
        PURCHASE_TYPE: (
            (),
            F.when(c("l_returnflag") == "R", "Consignment").otherwise(OUTRIGHT),
        ),
    }


# Dimension -> (column on the joined side so far, its key), in join order.
_JOINS = {
    "supplier": ("l_suppkey", "s_suppkey"),
    "nation": ("s_nationkey", "n_nationkey"),
    "region": ("n_regionkey", "r_regionkey"),
    "part": ("l_partkey", "p_partkey"),
    "orders": ("l_orderkey", "o_orderkey"),
}


def star_mart(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = MART_COLUMNS,
    outright: bool = False,
) -> DataFrame:
    """The mart columns asked for, joined from the star tables under ``path``.

    ``outright`` leaves consignment lines in the files, by the column that tells them.

    No join carries a hint: Spark broadcasts a dimension while its files are under
    the session's broadcast threshold and shuffles beyond it, where adaptive
    execution splits skewed keys.
    """
    exprs = _mart_columns()
    needed = {dim for name in columns for dim in exprs[name][0]}
    rows = read_table(spark, path, "lineitem")
    if outright:
        rows = rows.where("l_returnflag <> 'R' OR l_returnflag IS NULL")
    for dim, (left, key) in _JOINS.items():
        if dim in needed:
            table = read_table(spark, path, dim)
            rows = rows.join(table, F.col(left) == F.col(key))
    return rows.select(*[exprs[name][1].alias(name) for name in columns])
