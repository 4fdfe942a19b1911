"""The documents' columns that the operators read, and nulls in them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashcycle.llm.textops import text_buffer

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of rows that have an id; a null text stays null."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter(
        "doc_id IS NOT NULL"
    )


def fold_of(column: str, n: int):
    """crc32 of an id as text, modulo ``n``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def packed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, packed): texts compressed, half the bytes to shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            buf, offsets = text_buffer(batch.column("text"))
            packed = [pack(buf[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(packed, pa.binary())], ["doc_id", "packed"])

    return texts(docs).mapInArrow(run, "doc_id long, packed binary")


def packed_texts_with(docs: DataFrame, wanted: DataFrame, how: str = "inner") -> DataFrame:
    """``packed_texts`` joined to ``wanted`` by ``doc_id``, for a Python step that unpacks them.

    Always by a shuffle: behind a broadcast both steps would share tasks, and a task holds
    a worker for each, which executors keep.
    """
    return packed_texts(docs).join(wanted.hint("merge"), "doc_id", how)


def unpacked(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches with ``text`` for ``packed``, a few rows at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            part = batch.slice(lo, rows)
            at = part.schema.get_field_index("packed")
            data = pa.array([unpack(x.as_py()) for x in part.column(at)], pa.large_binary())
            columns = [data.cast(pa.large_string()) if k == at else c for k, c in enumerate(part.columns)]
            names = ["text" if n == "packed" else n for n in part.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names)
