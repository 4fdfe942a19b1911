"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

A document is the set of its distinct ``shingle``-word shingles. Its signature holds
``chunks * chunk_size`` MinHash values of 16 bits. Two signatures that differ in at most
``chunks * (errors + 1) - 1`` values have, by pigeonhole, a chunk with at most ``errors``
differing values; every way to leave ``errors`` values out of a chunk is enumerated as a
key, so such a pair always shares a key. With 9 chunks of 6 values and one error, all pairs
within distance 17 of 54 are found, and most beyond: a pair of Jaccard similarity 0.8 has a
mean distance of 10.8 and shares no key once in 14,000. Candidates further apart than
``max_distance`` (four and a half standard deviations more) are dropped, the others confirmed
on the full sets, read again from the texts of documents that share a key. A key holds
five values, so documents that only have a common passage seldom share one.

Documents with equal sets form one item before keys are made, so a group of copies of any
size costs one row. ``linking.linked_groups`` keeps groups of near copies from meeting in
all pairs.

Null and empty texts have no shingles, are linked with nothing and kept. Of rows with
the same ``doc_id`` the rows are told apart by nothing else: each gets the id's result. Rows
without an id are left out. Other columns are ignored by ``near_duplicates`` and
returned by ``keep_representatives``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashcycle.llm.linking import Close, linked_groups
from cashcycle.llm.scratch import Scratch, arrow_rows
from cashcycle.llm.tables import packed_texts_with, texts, unpacked
from cashcycle.llm.textops import chunks, document_shingles, mix, stream


@dataclass(frozen=True)
class NearDuplicateOptions:
    shingle: int = 5
    threshold_percent: int = 80
    chunks: int = 9
    chunk_size: int = 6
    errors: int = 1
    max_distance: int = 24

    @property
    def values(self) -> int:
        return self.chunks * self.chunk_size

    @property
    def radius(self) -> int:
        """The largest signature distance at which every pair is found."""
        return self.chunks * (self.errors + 1) - 1


def signature(shingles: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash values of 16 bits of a non-empty set."""
    factor = (stream(21, n) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    shift = (stream(22, n) >> np.uint64(32)).astype(np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(n, 0xFFFFFFFF, np.uint32)
    for lo in range(0, len(short), 4096):
        block = short[lo : lo + 4096, None] * factor + shift
        np.minimum(least, block.min(0), out=least)
    return (mix(least.astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)


def chunk_keys(signatures: np.ndarray, options: NearDuplicateOptions) -> np.ndarray:
    """The keys of each signature: all ways to leave ``errors`` values out of a chunk."""
    columns = []
    for chunk in range(options.chunks):
        at = chunk * options.chunk_size
        for kept in combinations(range(options.chunk_size), options.chunk_size - options.errors):
            key = np.full(len(signatures), len(columns) + 1, np.uint64)
            for k in kept:
                key = mix(key * np.uint64(0x10001) + signatures[:, at + k].astype(np.uint64))
            columns.append(key)
    return np.stack(columns, 1).view(np.int64)


def _binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = matrix.shape
    places = pa.array(np.arange(n + 1) * width, pa.int32())
    return pa.ListArray.from_arrays(places, pa.array(matrix.reshape(-1), kind))


def shingle_features(docs: DataFrame, options: NearDuplicateOptions) -> DataFrame:
    """Per document: size and digest of its set, signature and keys (null without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buf, offsets in chunks(batch):
                sets = document_shingles(buf, offsets, options.shingle)
                sizes = np.array([len(s) for s in sets], np.int64)
                digests = [
                    np.array([mix(s).sum(), mix(s + np.uint64(1)).sum(), len(s)], np.uint64).tobytes()
                    for s in sets
                ]
                signatures = np.zeros((len(sets), options.values), np.uint16)
                for k, s in enumerate(sets):
                    if len(s):
                        signatures[k] = signature(s, options.values)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(sizes),
                        _binary(digests),
                        _lists(signatures.view(np.int16), pa.int16()),
                        _lists(chunk_keys(signatures, options), pa.int64()),
                    ],
                    ["doc_id", "n_shingles", "digest", "signature", "keys"],
                )

    return texts(docs).mapInArrow(
        run,
        "doc_id long, n_shingles long, digest binary, signature array<smallint>, keys array<long>",
    )


def _shingle_sets(packed: DataFrame, size: int) -> DataFrame:
    """(id, shingles, short) of packed texts: the sorted hashes as bytes, and their first 16 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches):
            for rows, buf, offsets in chunks(batch):
                sets = document_shingles(buf, offsets, size)
                whole = _binary([s.tobytes() for s in sets])
                short = _binary([(s >> np.uint64(48)).astype("<u2").tobytes() for s in sets])
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), whole, short], ["id", "shingles", "short"])

    return packed.mapInArrow(run, "id long, shingles binary, short binary")


def _linked(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    small, large = (left, right) if len(left) <= len(right) else (right, left)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int((large[at] == small).sum())
    return 100 * common >= percent * (len(left) + len(right) - common)


def _similar(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, sa, sb) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                left, right = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                keep.append(_linked(left, right, percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(run, "a long, b long")


def _similar_members(
    left: pa.StructArray, right: pa.StructArray, asked: np.ndarray, options: NearDuplicateOptions
) -> np.ndarray:
    """Which of the pairs asked for can be similar enough, by sizes, signatures and short hashes:
    no fewer of these are common than of the whole ones."""
    sizes, signatures, sets = [], [], []
    for side in (left, right):
        item = side.field("item")
        sizes.append(item.field("n").to_numpy())
        signatures.append(item.field("signature").flatten().to_numpy().reshape(len(side), -1))
        sets.append([np.frombuffer(v.as_buffer(), "<u2") for v in item.field("short")])
    small, large = np.minimum(sizes[0][:, None], sizes[1]), np.maximum(sizes[0][:, None], sizes[1])
    linked = asked & (100 * small >= options.threshold_percent * large)
    there = np.zeros(1 << 16, bool)
    for k, own in enumerate(signatures[0]):
        linked[k] &= (own != signatures[1]).sum(1) <= options.max_distance
        others = np.flatnonzero(linked[k])
        if len(others):
            there[sets[0][k]] = True
            common = np.array([np.count_nonzero(there[sets[1][m]]) for m in others])
            either = sizes[0][k] + sizes[1][others] - common
            linked[k, others] = 100 * common >= options.threshold_percent * either
            there[sets[0][k]] = False
    return linked


ROWS = 512  # texts, or pairs with their sets, in a batch


def near_duplicates(
    docs: DataFrame, options: NearDuplicateOptions | None = None
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    Linked are documents with ``100 * intersection >= threshold_percent * union`` of their
    shingle sets; ``component_id`` is the smallest ``doc_id`` reachable over links.
    """
    options = options or NearDuplicateOptions()
    scratch = Scratch(docs.sparkSession)
    with arrow_rows(scratch.spark, ROWS):
        features = scratch.keep(shingle_features(docs, options), "features")
    worded = features.filter("n_shingles > 0")
    items = worded.groupBy("digest").agg(
        F.min(F.struct("doc_id", "n_shingles", "signature", "keys")).alias("item")
    )
    items = scratch.keep(items.select("digest", "item.*"), "items")

    tables: dict[str, DataFrame] = {}

    def prepare(ids: DataFrame) -> None:
        ids = scratch.keep(ids, "ids")
        brief = items.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "signature")
        tables["brief"] = scratch.keep(brief.join(ids, "id", "left_semi"), "brief")
        wanted = packed_texts_with(docs, ids.withColumnRenamed("id", "doc_id"), "left_semi")
        tables["sets"] = scratch.keep(_shingle_sets(wanted, options.shingle).dropDuplicates(["id"]), "sets")

    def close(left: Column, right: Column) -> Column:
        sizes = 100 * F.least(left["n"], right["n"]) >= options.threshold_percent * F.greatest(left["n"], right["n"])
        apart = F.zip_with(left["signature"], right["signature"], lambda x, y: x != y)
        return sizes & (F.size(F.filter(apart, lambda d: d)) <= options.max_distance)

    def brief() -> tuple[DataFrame, Close]:
        return tables["brief"].select("id", F.struct("n", "signature").alias("brief")), close

    def check(pairs: DataFrame) -> DataFrame:
        brief, sets = tables["brief"], tables["sets"]
        left = brief.select(F.col("id").alias("a"), F.struct("n", "signature").alias("left"))
        right = brief.select(F.col("id").alias("b"), F.struct("n", "signature").alias("right"))
        near = pairs.join(left, "a").join(right, "b").filter(close(F.col("left"), F.col("right")))
        both = near.select("a", "b").join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
        both = both.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
        return _similar(both, options.threshold_percent)

    def payload() -> DataFrame:
        whole = tables["brief"].join(tables["sets"], "id")
        return whole.select("id", F.struct("n", "signature", "short").alias("item"))

    def compare(left: pa.StructArray, right: pa.StructArray, asked: np.ndarray) -> np.ndarray:
        return _similar_members(left, right, asked, options)

    keys = items.select(F.explode("keys").alias("key"), F.col("doc_id").alias("id"))
    with arrow_rows(scratch.spark, ROWS):
        found = linked_groups(scratch, keys, prepare, check, payload, compare, brief=brief)
    scratch.drop("sets", "ids", "brief")
    classes = items.join(found, items.doc_id == found.id, "left").select(
        "digest", F.coalesce("component", "doc_id").alias("component_id")
    )
    result = features.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest"))
    result = result.join(classes, "digest", "left")
    result = result.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return result.select(
        "doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")
    )


def keep_representatives(docs: DataFrame, options: NearDuplicateOptions | None = None) -> DataFrame:
    """``docs`` without the near duplicates: one document of each group stays, unchanged."""
    kept = near_duplicates(docs, options).filter("kept").select(F.col("doc_id").alias("__kept_id"))
    return docs.join(kept.distinct(), F.col("doc_id") == F.col("__kept_id"), "left_semi")
