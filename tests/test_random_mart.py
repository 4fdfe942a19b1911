"""Every report query on a random mart full of gaps, against the same SQL.

The test tables have no missing values and few ties; this mart has missing keys and
measures, copies, ties, zero and negative amounts, suppliers without recent rows and
marker brands. Queries and SQL are unchanged, only the mart under them is replaced.
"""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import duckdb
import pytest
from compare import canonical

from cashcycle.catalog import oracle
from cashcycle.catalog import queries as catalog
from cashcycle.schema import KEYS, MONEY

MART_DDL = (
    "grass_region string, category_cluster string, supplier_name string, sku_id string, "
    "cdate date, color string, cogs_usd decimal(18,4), stock_on_hand int, "
    "inbound_value_usd decimal(18,4), acct_payables_usd decimal(18,4), "
    "inventory_value_usd decimal(18,4), payment_terms string, brand string, "
    "grass_date date, purchase_type string"
)
OTHER_TABLES = ("brand_canonical", "period_calendar")
NAMES = [name for name in catalog.QUERIES if name not in OTHER_TABLES]


def random_rows(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)

    def maybe(value, gap=0.15):
        return None if rng.random() < gap else value

    def money():
        return maybe(Decimal(rng.choice(["0", "0", "1", "2.5", "99.9999", "-5.1663"])))

    rows = []
    for as_of in (catalog.MID_MONTH.as_of, catalog.MONTH_END.as_of):
        for _ in range(n):
            age = 0 if rng.random() < 0.2 else rng.randrange(-3, 160)
            supplier = rng.choice(["A", "B, Ltd", "ฮาตาริ", "old", "hot", "hot", "hot"])
            if supplier == "old":
                age = 60 + abs(age)
            rows.append(
                (
                    rng.choice(catalog.REGIONS),
                    maybe(rng.choice(["EL", "FMCG", "Fashion"]), 0.3),
                    maybe(supplier, 0.02),
                    maybe(str(rng.randrange(8))),
                    maybe(as_of - timedelta(days=rng.randrange(200))),
                    maybe(rng.choice(["Green", "Black", "Yellow"])),
                    money(),
                    maybe(rng.randrange(-2, 50)),
                    money(),
                    money(),
                    money(),
                    maybe(rng.choice(["30 NET", "7 NET", "Immediately"])),
                    maybe(rng.choice(["a", "b", "c", "d", "nan", "x y"])),
                    as_of - timedelta(days=age),
                    maybe(rng.choice(["Outright"] * 4 + ["Consignment"]), 0.05),
                )
            )
    return rows + rows[:: 7]


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("random") / "mart")
    spark.createDataFrame(random_rows(11, 1500), MART_DDL).write.parquet(path)
    return path


@pytest.fixture
def on_random_mart(spark, mart, monkeypatch):
    table = spark.read.schema(MART_DDL).parquet(mart)
    monkeypatch.setattr(
        catalog,
        "star_mart",
        lambda spark, path, columns, outright=False: table.select(*columns),
    )
    watchlist = table.where("sku_id = '1' AND grass_region <> 'EUROPE'").select(*KEYS)
    monkeypatch.setattr(catalog, "star_watchlist", lambda spark, path: watchlist)


@pytest.fixture(scope="module")
def connection(mart):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW raw AS SELECT * FROM '{mart}/*.parquet'")
    return connection


def random_sql(name: str) -> str:
    watchlist = f"""watchlist AS (
      SELECT {oracle.KEYS} FROM raw WHERE sku_id = '1' AND grass_region <> 'EUROPE'
    )"""
    text = oracle.ORACLES[name]
    assert oracle.MART in text
    return text.replace(oracle.MART, "mart AS (SELECT * FROM raw)").replace(
        oracle.WATCHLIST, watchlist
    )


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, on_random_mart, connection, name):
    ours = catalog.registered()[name](spark, "unused").toPandas()
    theirs = connection.execute(random_sql(name)).df()
    assert len(ours) > 0
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)


def test_money_type():
    assert MONEY.simpleString() in MART_DDL
    assert date(1998, 11, 18) == catalog.MID_MONTH.as_of
