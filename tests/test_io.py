"""Reading and writing marts, extracts, reports and watchlists."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from marts import AS_OF, mart
from pyspark.sql import functions as F

from cashcycle import ReportPeriods, extract, run_report, write_report
from cashcycle.schema import EXTRACT_SCHEMA
from cashcycle.sources import storage
from cashcycle.sources.mart import (
    CSV_OPTIONS,
    broken_files,
    read_extract,
    read_mart,
    write_extract,
    write_mart,
)
from cashcycle.sources.publish import Publication
from cashcycle.sources.watchlist import read_watchlist, read_watchlist_yaml

SPAN = ReportPeriods(AS_OF).extract_span
ODD_NAMES = ['Co., "Ltd"', " blanks ", "ฮาตาริ (Outright)", "back\\slash", "'single'"]


@pytest.fixture
def typed_extract(spark):
    rows = [{"supplier_name": name, "sku_id": str(n)} for n, name in enumerate(ODD_NAMES)]
    rows.append({"supplier_name": "gaps", "brand": None, "cdate": None, "cogs_usd": None})
    rows.append({"supplier_name": "negative", "cogs_usd": -5.1663, "color": None})
    return extract(mart(spark, *rows), SPAN).to(EXTRACT_SCHEMA)


def sorted_rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_extract_roundtrip(spark, typed_extract, tmp_path, fmt):
    path = f"{tmp_path}/extract"
    write_extract(typed_extract, path, fmt)
    write_extract(typed_extract, path, fmt)
    copy = read_extract(spark, path, fmt)
    assert copy.schema == typed_extract.schema
    assert sorted_rows(copy) == sorted_rows(typed_extract)
    negative = copy.where("supplier_name = 'negative'").first()
    assert negative.cogs_usd == Decimal("-5.1663")


def test_inferred_extract(spark, typed_extract, tmp_path):
    path = f"{tmp_path}/extract"
    write_extract(typed_extract, path)
    copy = read_extract(spark, path, schema=None)
    types = dict(copy.dtypes)
    assert types["grass_date"] == types["cdate"] == "date"
    assert types["cogs_usd"] == "double"
    assert sorted(r.supplier_name for r in copy.collect()) == sorted(
        [*ODD_NAMES, "gaps", "negative"]
    )


def test_mart_partitions_are_pruned(spark, tmp_path):
    path = f"{tmp_path}/mart"
    source = mart(
        spark,
        *[
            {"grass_region": region, "grass_date": AS_OF - timedelta(days=n)}
            for region in ("R1", "R2")
            for n in range(5)
        ],
    )
    write_mart(source, path)
    table = read_mart(spark, path)
    assert table.count() == 10
    rows = extract(table, SPAN, regions=["R2"]).where(f"grass_date = DATE '{AS_OF}'")
    assert len(rows.inputFiles()) == 10
    plan = rows._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "grass_region" in partition_filters and "grass_date" in partition_filters
    assert rows.count() == 1


def test_report_is_written_per_region(spark, tmp_path):
    source = mart(
        spark,
        {"supplier_name": "b, c"},
        {"supplier_name": "a"},
        {"grass_region": "R2", "supplier_name": "z"},
    )
    report = run_report(source, AS_OF)
    folders = write_report(report, f"{tmp_path}/report")
    assert set(folders) == set(report)
    for name, folder in folders.items():
        regions = {p.name for p in (tmp_path / "report" / name).iterdir() if p.is_dir()}
        assert regions == {"grass_region=R1", "grass_region=R2"}
        copy = read_extract(spark, folder, schema=report[name].schema)
        assert sorted_rows(copy.select(*report[name].columns)) == sorted_rows(report[name])
    file = next((tmp_path / "report/tracking/grass_region=R1").glob("*.csv"))
    lines = file.read_text(encoding="utf-8").splitlines()
    assert lines[0].startswith("category_cluster,supplier_name,no_skus_WH")
    assert [line.split(",")[1] for line in lines[1:]] == ["a", '"b']


def published(spark, path, name="tracking"):
    rows = spark.read.parquet(f"{path}/{name}").select("grass_region", "supplier_name", "inv_count")
    return sorted(map(tuple, rows.collect()))


def tracked(spark, *rows):
    return spark.createDataFrame(rows, "grass_region string, supplier_name string, inv_count int")


def test_regions_of_other_runs_stay(spark, tmp_path):
    path = f"{tmp_path}/report"
    write_report({"tracking": tracked(spark, ("VN", "a", 1), ("ID/x", "b", 1))}, path, "parquet", ["VN", "ID/x"])
    write_report({"tracking": tracked(spark, ("TH", "c", 1))}, path, "parquet", ["TH"])
    assert published(spark, path) == [("ID/x", "b", 1), ("TH", "c", 1), ("VN", "a", 1)]
    write_report({"tracking": tracked(spark, ("VN", "d", 2))}, path, "parquet", ["VN", "ID/x"])
    assert published(spark, path) == [("TH", "c", 1), ("VN", "d", 2)]
    write_report({"tracking": tracked(spark, ("MY", "e", 1))}, path, "parquet")
    assert published(spark, path) == [("MY", "e", 1)]
    assert [p.name for p in (tmp_path / "report").iterdir()] == ["tracking"]


def test_failed_run_leaves_the_old_tables(spark, tmp_path):
    path = f"{tmp_path}/report"
    old = {"tracking": tracked(spark, ("VN", "a", 1)), "cogs": tracked(spark, ("VN", "a", 1))}
    write_report(old, path, "parquet")
    new = tracked(spark, ("VN", "b", 2))
    broken = new.withColumn("inv_count", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        write_report({"tracking": new, "cogs": broken}, path, "parquet", ["VN"])
    assert published(spark, path) == published(spark, path, "cogs") == [("VN", "a", 1)]
    assert sorted(p.name for p in (tmp_path / "report").iterdir()) == ["cogs", "tracking"]


def test_publication_that_breaks_off_is_undone(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/report"
    write_report({n: tracked(spark, ("VN", "a", 1), ("TH", "b", 1)) for n in ("tracking", "cogs")}, path, "parquet")
    move, moves = Publication._move, []

    def fails_later(self, source, target):
        if len(moves) == 6:
            raise OSError("no more moves")
        moves.append(target)
        move(self, source, target)

    monkeypatch.setattr(Publication, "_move", fails_later)
    with pytest.raises(OSError, match="no more moves"):
        write_report({n: tracked(spark, ("VN", "c", 2), ("TH", "d", 2)) for n in ("tracking", "cogs")}, path, "parquet")
    for name in ("tracking", "cogs"):
        assert published(spark, path, name) == [("TH", "b", 1), ("VN", "a", 1)]


def test_watchlist_table(spark, tmp_path):
    file = tmp_path / "watchlist.csv"
    file.write_text('grass_region,supplier_name\nR1,"A, Ltd"\nR2,\n', encoding="utf-8")
    rows = sorted(map(tuple, read_watchlist(spark, str(file)).collect()))
    assert rows == [("R1", "A, Ltd"), ("R2", None)]


def test_watchlist_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    file = tmp_path / "watchlist.yaml"
    file.write_text("R1:\n  - A, Ltd\n  - B\nR2:\n", encoding="utf-8")
    rows = sorted(map(tuple, read_watchlist_yaml(spark, str(file)).collect()))
    assert rows == [("R1", "A, Ltd"), ("R1", "B")]


class _Context:
    def __init__(self, master):
        self.master = master
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master, configured=None):
        self.sparkContext = _Context(master)
        self.configured = configured
        self.conf = self

    def get(self, key, default):
        return self.configured or default


def test_shared_dir_comes_from_the_session():
    assert storage.shared_dir(_Session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(_Session("yarn"))
    local = _Session("local[2]")
    assert storage.shared_dir(local).startswith("file:///")
    assert storage.shared_dir(local) == local.sparkContext.folder


def test_staged_table_is_read_from_the_written_copy(spark):
    df = spark.range(10).selectExpr("id", "date_add(DATE '2020-01-01', CAST(id AS INT)) AS d")
    staged = storage.stage(df, "numbers")
    assert staged.inputFiles() and "numbers-" in staged.inputFiles()[0]
    assert sorted(staged.collect()) == sorted(df.collect())
    assert staged.where("d = DATE '2020-01-02'").first().id == 1


def test_dates_survive(typed_extract):
    assert typed_extract.first().grass_date == date(2019, 11, 18)


def awkward_extract(spark):
    row = dict.fromkeys(EXTRACT_SCHEMA.names)
    names = ['PT ""Maju"", Tbk', "a,b", "  padded  ", "O'Neil \\ Söhne"]
    rows = [row | {"supplier_name": n, "grass_region": "VN", "sku_id": f"00{k}"} for k, n in enumerate(names)]
    return spark.createDataFrame([tuple(r[c] for c in EXTRACT_SCHEMA.names) for r in rows], EXTRACT_SCHEMA)


BREAKS = ["a\nb", "c\r\nd", "\n", "x,\n\"y\", z\n", "tail\n\n"]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_line_breaks_survive(spark, tmp_path, fmt):
    source = awkward_extract(spark)
    row = source.first().asDict()
    broken = spark.createDataFrame([tuple((row | {"supplier_name": n}).values()) for n in BREAKS], EXTRACT_SCHEMA)
    write_extract(source.repartition(2).unionAll(broken.coalesce(1)), f"{tmp_path}/x", fmt)
    copy = read_extract(spark, f"{tmp_path}/x", fmt)
    assert sorted(map(str, copy.collect())) == sorted(map(str, source.unionAll(broken).collect()))
    if fmt == "csv":
        assert len(broken_files(spark, f"{tmp_path}/x")) == 1
        inferred = read_extract(spark, f"{tmp_path}/x", schema=None)
        assert inferred.count() == copy.count()


def test_only_files_with_line_breaks_are_read_whole(spark, tmp_path):
    path = tmp_path / "x"
    path.mkdir()
    head = ",".join(EXTRACT_SCHEMA.names)
    lines = "".join(f'VN,,"Supplier, ""{k}""",{k:06}{"," * 10}\n' for k in range(3000))
    (path / "plain %41.csv").write_text(f"{head}\n{lines}", encoding="utf-8")
    (path / "broken.csv").write_text(f'{head}\nVN,,"two\nlines",x{"," * 10}\n', encoding="utf-8")
    assert [f.rsplit("/", 1)[1] for f in broken_files(spark, str(path))] == ["broken.csv"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        copy = read_extract(spark, str(path))
        assert copy.rdd.getNumPartitions() > 4
        assert copy.count() == 3001
        assert copy.where("sku_id = 'x'").first().supplier_name == "two\nlines"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_columns_are_found_by_name(spark, tmp_path):
    source = awkward_extract(spark)
    shuffled = source.select(*sorted(source.columns, reverse=True), F.lit(1).alias("more"))
    write_extract(shuffled, f"{tmp_path}/x")
    assert sorted(map(str, read_extract(spark, f"{tmp_path}/x").collect())) == sorted(map(str, source.collect()))
    with pytest.raises(ValueError, match="sku_id"):
        write_extract(source.drop("sku_id"), f"{tmp_path}/y")
        read_extract(spark, f"{tmp_path}/y")


def test_inferred_copy_keeps_text(spark, tmp_path):
    write_extract(awkward_extract(spark), f"{tmp_path}/x")
    copy = read_extract(spark, f"{tmp_path}/x", schema=None)
    assert sorted(r.sku_id for r in copy.collect()) == ["000", "001", "002", "003"]


def test_watchlist_with_quotes_and_other_order(spark, tmp_path):
    rows = [("VN", 'PT ""Maju"", Tbk'), ("ID", "a, b")]
    table = spark.createDataFrame(rows, "grass_region string, supplier_name string")
    table.select("supplier_name", "grass_region").write.options(**CSV_OPTIONS).csv(f"{tmp_path}/w")
    assert sorted(map(tuple, read_watchlist(spark, f"{tmp_path}/w").collect())) == sorted(rows)


def test_writing_a_day_keeps_the_others(spark, tmp_path):
    for day in (date(2019, 1, 1), date(2019, 1, 2)):
        rows = awkward_extract(spark).withColumns(
            {"grass_date": F.lit(day), "purchase_type": F.lit("Outright")}
        )
        write_mart(rows, f"{tmp_path}/mart")
    found = read_mart(spark, f"{tmp_path}/mart").groupBy("grass_date").count().collect()
    assert sorted(r["count"] for r in found) == [4, 4]
