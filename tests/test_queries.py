"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import pytest
from compare import canonical, duck

import __spark_entry__ as driver
from cashcycle.catalog.queries import registered

QUERIES = driver.queries()
ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    own = registered()
    assert set(own) == {name for name in ORACLES if name in own}


@pytest.mark.parametrize("name", list(registered()))
def test_query(spark, sf_dir, connection, name):
    ours = QUERIES[name](spark, sf_dir).toPandas()
    theirs = connection.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)


def test_entry_has_rows(spark):
    table = driver.entry(spark)
    assert table.count() > 0
    assert len(table.columns) == 23


@pytest.mark.parametrize(
    "name", ["scorecard", "sheet_inbound", "working_capital_days", "brand_counts", "watchlist"]
)
def test_query_without_broadcasts(spark, sf_dir, connection, name):
    """The same results when no table is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ours = QUERIES[name](spark, sf_dir)
        plan = ours._jdf.queryExecution().executedPlan().toString()
        ours = ours.toPandas()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    assert canonical(ours) == canonical(connection.execute(ORACLES[name]).df())
