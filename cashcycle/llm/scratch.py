"""Tables that an operator writes to the shared folder and reads again."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from cashcycle.sources.storage import new_path


class Scratch:
    """Written tables of one call. A lost executor costs a re-read of a file; a table that
    is no longer needed can be deleted before the call ends."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def keep(self, df: DataFrame, name: str, at_once: int | None = None) -> DataFrame:
        """Write ``df`` and go on from the written copy. ``at_once``: so many rows are held together
        by who writes or reads it, for tables with long rows."""
        self.drop(name)
        path = new_path(self.spark, name)
        # Parquet looks at the bytes of a page after 100 rows only, and packs it in memory beside the heap
        df.write.options(**{} if at_once is None else {"parquet.block.row.count.limit": at_once}).parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        context = self.spark.sparkContext
        for name in names:
            path = self.paths.pop(name, None)
            if path is not None:
                place = context._jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def arrow_rows(spark: SparkSession, n: int) -> Iterator[None]:
    """Jobs that run inside hand their Python tasks batches of at most ``n`` rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)
