"""The report job from the command line's point of view."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from marts import AS_OF, mart

from cashcycle.__main__ import parse, run
from cashcycle.plans.report import ALL_TABLES
from cashcycle.sources.mart import write_mart


@pytest.fixture
def mart_path(spark, tmp_path):
    path = f"{tmp_path}/mart"
    money = "cogs_usd inbound_value_usd acct_payables_usd inventory_value_usd".split()
    source = mart(
        spark,
        {},
        {"supplier_name": "T", "brand": None},
        {"grass_region": "R2", "supplier_name": "U", "grass_date": AS_OF - timedelta(days=3)},
        {"grass_region": "R3", "supplier_name": "V", "cogs_usd": 2.5},
    )
    typed = source.withColumns({name: source[name].cast("decimal(18,4)") for name in money})
    write_mart(typed, path)
    return path


def test_default_date_is_yesterday():
    args = parse(["--mart", "m", "--out", "o"])
    assert args.date == date.today() - timedelta(days=1)
    assert (args.regions, args.tables) == (None, None)


def test_mart_and_cached_extract_give_the_same_report(spark, mart_path, tmp_path):
    (tmp_path / "watchlist.csv").write_text("grass_region,supplier_name\nR1,T\n")
    common = ["--date", "20191118", "--watchlist", f"{tmp_path}/watchlist.csv"]
    common += ["--tables", "tracking", "tracking_yaml", "scorecard", "cogs"]
    first = run(
        spark,
        parse(
            ["--mart", mart_path, "--regions", "R1", "R3", "--out", f"{tmp_path}/a"]
            + ["--save-extract", f"{tmp_path}/extract", *common]
        ),
    )
    second = run(
        spark,
        parse(["--extract", f"{tmp_path}/extract", "--out", f"{tmp_path}/b", *common]),
    )
    assert set(first) == {"tracking", "tracking_yaml", "scorecard", "cogs"}
    for name in first:
        one, two = (
            sorted(map(tuple, spark.read.csv(f[name], header=True).collect()), key=str)
            for f in (first, second)
        )
        assert one == two
    suppliers = [
        r.supplier_name
        for r in spark.read.csv(first["tracking_yaml"], header=True).collect()
    ]
    assert sorted(suppliers) == ["T", "V"]


def test_region_and_date_of_a_cached_extract(spark, mart_path, tmp_path):
    run(
        spark,
        parse(
            ["--mart", mart_path, "--date", "20191118", "--out", f"{tmp_path}/a"]
            + ["--tables", "tracking", "--save-extract", f"{tmp_path}/extract"]
        ),
    )
    folders = run(
        spark,
        parse(
            ["--extract", f"{tmp_path}/extract", "--date", "20191115"]
            + ["--regions", "R2", "R3", "--out", f"{tmp_path}/b", "--tables", "tracking", "cogs"]
        ),
    )
    for name in ("tracking", "cogs"):
        table = spark.read.csv(folders[name], header=True)
        assert [(r.grass_region, r.supplier_name) for r in table.collect()] == [("R2", "U")]


def test_calendar_months_write_no_scorecard(spark, mart_path, tmp_path):
    folders = run(
        spark,
        parse(
            ["--mart", mart_path, "--date", "20191118", "--out", f"{tmp_path}/r"]
            + ["--calendar-months"]
        ),
    )
    assert "scorecard" not in folders
    sheet = spark.read.csv(folders["sheet_inbound"], header=True)
    assert sheet.columns[:5] == [
        "category_cluster",
        "supplier_name",
        "inb_m2",
        "inb_m1",
        "inb_m0",
    ]
    assert len(folders) == len(ALL_TABLES) - 1


def test_kept_cells_and_parquet_give_the_same_tables(spark, mart_path, tmp_path):
    common = ["--mart", mart_path, "--date", "20191118", "--tables", "tracking", "cogs"]
    first = run(spark, parse([*common, "--out", f"{tmp_path}/a"]))
    second = run(
        spark,
        parse([*common, "--out", f"{tmp_path}/b", "--kept", f"{tmp_path}/kept", "--format", "parquet"]),
    )
    third = run(
        spark,
        parse(
            [*common, "--out", f"{tmp_path}/c", "--save-extract", f"{tmp_path}/x"]
            + ["--extract-format", "parquet", "--sku-sketches"]
        ),
    )
    for name in first:
        one = sorted(map(str, spark.read.csv(first[name], header=True, inferSchema=True).collect()))
        assert one == sorted(map(str, spark.read.csv(third[name], header=True, inferSchema=True).collect()))
        assert len(one) == spark.read.parquet(second[name]).count()
    with pytest.raises(SystemExit):
        parse(["--extract", "x", "--kept", "y", "--out", "z"])


def test_runs_for_regions_in_turn_keep_each_other(spark, mart_path, tmp_path):
    for region in ("R1", "R3"):
        folders = run(
            spark,
            parse(
                ["--mart", mart_path, "--date", "20191118", "--regions", region]
                + ["--out", f"{tmp_path}/r", "--tables", "tracking"]
            ),
        )
    table = spark.read.csv(folders["tracking"], header=True)
    assert sorted(r.supplier_name for r in table.collect()) == ["S", "T", "V"]
