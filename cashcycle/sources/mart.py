"""The mart extract, its cached copies and the partitioned mart table."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashcycle.functions.periods import Span
from cashcycle.schema import (
    DAY,
    EXTRACT_COLUMNS,
    EXTRACT_SCHEMA,
    MEASURES,
    OUTRIGHT,
    PURCHASE_TYPE,
    REGION,
    SUPPLIER,
    UNITS,
)

# Values are written as they are: no trimming, quotes doubled.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

CSV_FILE_ROWS = 1_000_000


def extract(
    mart: DataFrame,
    span: Span,
    regions: Iterable[str] | None = None,
    columns: Sequence[str] = EXTRACT_COLUMNS,
) -> DataFrame:
    """Outright rows with a supplier and a region in a range of days."""
    rows = mart.where(
        F.col(SUPPLIER).isNotNull()
        & F.col(REGION).isNotNull()
        & span.contains()
        & (F.col(PURCHASE_TYPE) == OUTRIGHT)
    )
    if regions is not None:
        rows = rows.where(F.col(REGION).isin(list(regions)))
    return rows.select(*columns)


def write_mart(df: DataFrame, path: str) -> None:
    """Write the mart partitioned by region and day; other regions and days stay.

    The rebalance hint gathers each partition's rows into few files and splits a
    partition that is too large for one task.
    """
    (
        df.hint("rebalance", REGION, DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(REGION, DAY)
        .parquet(path)
    )


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType(
        [*EXTRACT_SCHEMA.fields, T.StructField(PURCHASE_TYPE, T.StringType())]
    )
    return spark.read.schema(schema).parquet(path)


def broken_files(spark: SparkSession, path: str) -> list[str]:
    """The CSV files under ``path`` in which a quoted value goes over several lines.

    Quotes within values are doubled, so a line with an odd number of them begins or ends such
    a value. Lines are counted in parallel; only the names of the files found come back.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return [row.file for row in lines.where(quotes % 2 == 1).select("file").distinct().collect()]


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, infer: Iterable[str] = ()
) -> DataFrame:
    """The schema's columns of CSV files, found by the names in their header.

    Columns named in ``infer`` get the type that Spark infers, all others the schema's.
    Missing columns and malformed rows are errors. Files are split among tasks, but for those
    with line breaks in values, each of which one task reads.
    """
    infer = set(infer)
    broken = broken_files(spark, path)
    found = spark.read.options(**CSV_OPTIONS, inferSchema=bool(infer), multiLine=bool(broken)).csv(path)
    missing = [f.name for f in schema.fields if f.name not in found.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    declared = {f.name: f.dataType for f in schema.fields if f.name not in infer}
    ordered = T.StructType(
        [T.StructField(f.name, declared.get(f.name, f.dataType)) for f in found.schema.fields]
    )

    def read(files: str | list[str], unsplit: bool, **more: str) -> DataFrame:
        reader = spark.read.schema(ordered).options(**CSV_OPTIONS, **more)
        reader = reader.options(mode="FAILFAST", enforceSchema=False, multiLine=unsplit)
        return reader.csv(files).select(*schema.names)

    if not broken:
        return read(path, False)
    unsplit = sorted(map(_plain_name, broken))
    whole = sorted(set(map(_plain_name, found.inputFiles())).difference(unsplit))
    if not whole:
        return read(path, True)
    return read(unsplit, True, basePath=path).unionAll(read(whole, False, basePath=path))


def _plain_name(name: str) -> str:
    """A file's name the same way wherever Spark got it from."""
    return unquote(re.sub("^file:/+", "file:/", name))


def write_extract(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Export an extract; CSV parts carry a header line each.

    A CSV file that has line breaks in values is read by one task, so files are kept to
    ``CSV_FILE_ROWS`` rows.
    """
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.options(**CSV_OPTIONS, maxRecordsPerFile=CSV_FILE_ROWS).csv(path)
    else:
        writer.format(fmt).save(path)


def read_extract(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | None = EXTRACT_SCHEMA,
) -> DataFrame:
    """Read a cached extract; ``schema=None`` lets Spark infer the measures of CSV files."""
    if fmt == "csv":
        infer = (*MEASURES, UNITS) if schema is None else ()
        return read_csv(spark, path, schema or EXTRACT_SCHEMA, infer)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(fmt).load(path)
