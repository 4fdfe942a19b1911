"""Column names and types of the daily supplier-SKU mart."""

from __future__ import annotations

from pyspark.sql import types as T

# Mart column names and the markers the reports use.
REGION = "grass_region"
SUPPLIER = "supplier_name"
DAY = "grass_date"
CATEGORY = "category_cluster"
SKU = "sku_id"
CREATED = "cdate"
COLOR = "color"
BRAND = "brand"
TERMS = "payment_terms"
PURCHASE_TYPE = "purchase_type"

COGS = "cogs_usd"
UNITS = "stock_on_hand"
INBOUND = "inbound_value_usd"
PAYABLES = "acct_payables_usd"
INVENTORY = "inventory_value_usd"

OUTRIGHT = "Outright"
GREEN = "Green"
BLACK = "Black"
NO_BRAND = "n.a."
NOT_AVAILABLE = "N/A"
MISSING_BRAND_TEXT = "nan"

#: One supplier of one region; the grain of every report row.
KEYS = (REGION, SUPPLIER)

#: Money measures that are summed (flows) or averaged (stocks) over time.
FLOWS = (COGS, INBOUND)
STOCKS = (INVENTORY, PAYABLES)
MEASURES = (COGS, UNITS, INBOUND, PAYABLES, INVENTORY)

MONEY = T.DecimalType(18, 4)

#: Columns of the extract, in output order.
EXTRACT_SCHEMA = T.StructType(
    [
        T.StructField(REGION, T.StringType()),
        T.StructField(CATEGORY, T.StringType()),
        T.StructField(SUPPLIER, T.StringType()),
        T.StructField(SKU, T.StringType()),
        T.StructField(CREATED, T.DateType()),
        T.StructField(COLOR, T.StringType()),
        T.StructField(COGS, MONEY),
        T.StructField(UNITS, T.IntegerType()),
        T.StructField(INBOUND, MONEY),
        T.StructField(PAYABLES, MONEY),
        T.StructField(INVENTORY, MONEY),
        T.StructField(TERMS, T.StringType()),
        T.StructField(BRAND, T.StringType()),
        T.StructField(DAY, T.DateType()),
    ]
)
EXTRACT_COLUMNS = tuple(EXTRACT_SCHEMA.fieldNames())

#: The mart itself also carries the purchase type, which the extract filters on.
MART_COLUMNS = EXTRACT_COLUMNS + (PURCHASE_TYPE,)
