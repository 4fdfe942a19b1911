"""Small hand-made marts."""

from __future__ import annotations

from datetime import date

from golden import MART_DDL

AS_OF = date(2019, 11, 18)
DEFAULTS = {
    "grass_region": "R1",
    "category_cluster": "EL",
    "supplier_name": "S",
    "sku_id": "1",
    "cdate": date(2019, 1, 1),
    "color": "Green",
    "cogs_usd": 1.0,
    "stock_on_hand": 1,
    "inbound_value_usd": 1.0,
    "acct_payables_usd": 1.0,
    "inventory_value_usd": 1.0,
    "payment_terms": "30 NET",
    "brand": "B",
    "grass_date": AS_OF,
    "purchase_type": "Outright",
}


def mart(spark, *rows: dict):
    """A mart from rows that say only how they differ from the default row."""
    return spark.createDataFrame([tuple((DEFAULTS | row).values()) for row in rows], MART_DDL)


def by_supplier(table) -> dict:
    return {row["supplier_name"]: row for row in table.collect()}
