"""Exact repeated substrings: every byte covered by a string of ``length`` bytes that also
starts elsewhere, in the same or another document.

A window is a string of ``length`` bytes. Its anchor is the ``anchor``-byte string in it with the
smallest hash, the leftmost of equal ones: equal windows have equal anchors at equal
places. So only windows whose anchor occurs twice can repeat, and anchors are a few
hundredths of all positions. The windows of one anchor occurrence are neighbours; together
they span a stretch of text.

1. Anchors are counted; those that occur once are dropped.
2. Stretches that are equal throughout repeat as a whole: the inside of long repeats, copies of
   whole documents. They are counted by hash.
3. Where stretches of one anchor differ (the ends of repeats, edits), one occurrence of each
   different stretch lists its windows, and windows found in two stretches repeat.

Equal means equal in two 64-bit hashes, of the anchor and of the stretch or window. All
steps are grouping and joining by hash, combined before the shuffle; what a passage
in a third of all documents costs grows with its occurrences. Documents meet
their removed parts packed.

Null texts count as empty. Texts shorter than ``length`` lose nothing, and windows never
cross documents. Rows with one ``doc_id`` are different documents if their texts differ; equal rows
are copies of each other. Rows without ``doc_id`` are left out; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcycle.llm.scratch import Scratch
from cashcycle.llm.tables import texts
from cashcycle.llm.textops import chunks, mix, prefix_sums, range_hashes, text_buffer


@dataclass(frozen=True)
class RepeatOptions:
    length: int = 200
    anchor: int = 100


def _window_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbouring hashes."""
    n = len(hashes)
    padded = np.concatenate([hashes, np.full(-n % width, 2**64 - 1, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).reshape(-1)[:n]
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)[:n]
    m = n - width + 1
    return np.minimum(behind[:m], ahead[width - 1 :])


def anchors(buf: np.ndarray, options: RepeatOptions) -> tuple[np.ndarray, ...]:
    """Of one document: the first window and the number of windows of each anchor
    occurrence, the anchor's hash and the hash of the stretch."""
    if len(buf) < options.length:
        empty = np.empty(0, np.uint64)
        return empty.astype(np.int64), empty.astype(np.int64), empty, empty
    sums = prefix_sums(buf)
    places = np.arange(len(buf) - options.anchor + 1)
    hashes = range_hashes(sums, places, places + options.anchor)
    width = options.length - options.anchor + 1
    least = _window_minima(hashes, width)
    # a new anchor begins where the hash changes, or behind an anchor that starts its window
    new = least[1:] != least[:-1]
    new |= hashes[: len(new)] == least[:-1]
    new = np.flatnonzero(new) + 1
    first = np.concatenate([[0], new])
    last = np.concatenate([new, [len(least)]])
    stretches = range_hashes(sums, first, last - 1 + options.length)
    return first, last - first, least[first], mix(stretches + (last - first).astype(np.uint64))


def _keyed(docs: DataFrame) -> DataFrame:
    rows = texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumn("digest", F.hash("text"))


def _anchor_table(docs: DataFrame, options: RepeatOptions) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buf, offsets in chunks(batch):
                found = [anchors(buf[a:b], options) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                owner = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
                first, n, anchor, stretch = (np.concatenate(c) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id").take(pa.array(owner)),
                        rows.column("digest").take(pa.array(owner)),
                        pa.array(first.astype(np.int64)),
                        pa.array(n.astype(np.int32)),
                        pa.array(anchor.view(np.int64)),
                        pa.array(stretch.view(np.int64)),
                    ],
                    ["doc_id", "digest", "first", "n", "anchor", "stretch"],
                )

    return _keyed(docs).mapInArrow(
        run, "doc_id long, digest int, first long, n int, anchor long, stretch long"
    )


def _windows(packed: DataFrame, options: RepeatOptions) -> DataFrame:
    """(window, edge, at): the window hashes of the stretches asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            columns = zip(batch.column("packed"), batch.column("asked"), strict=True)
            for data, asked in columns:
                sums = prefix_sums(np.frombuffer(unpack(data.as_py()), np.uint8))
                first, n, anchor, edge = (
                    asked.values.field(c).to_numpy(zero_copy_only=False) for c in ("first", "n", "anchor", "edge")
                )
                owner = np.repeat(np.arange(len(first)), n)
                at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                start = first[owner] + at
                hashes = range_hashes(sums, start, start + options.length)
                # of the anchor and the window: equal windows have equal anchors
                keys = mix(hashes + mix(anchor.view(np.uint64))[owner])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(edge[owner]), pa.array(at.astype(np.int16))],
                    ["window", "edge", "at"],
                )

    return packed.mapInArrow(run, "window long, edge long, at smallint")


def _shared(windows: DataFrame) -> DataFrame:
    """(edge, at) of windows that occur in several stretches, from rows sorted by window.

    A run of equal windows is handed on row by row, so it needs no memory of its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row: window, edge, at, whether it is known to repeat
        names = ("window", "edge", "at")
        for batch in batches:
            if not batch.num_rows:
                continue
            window, edge, at = (batch.column(c).to_numpy(zero_copy_only=False) for c in names)
            known = np.zeros(len(window), bool)
            if held is not None:
                window, edge, at = (np.append(h, x) for h, x in zip(held[:3], (window, edge, at), strict=True))
                known = np.append(held[3], known)
            same = window[1:] == window[:-1]
            hit = known
            hit[1:] |= same
            hit[:-1] |= same
            out = hit[:-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(edge[:-1][out]), pa.array(at[:-1][out].astype(np.int16))], ["edge", "at"]
            )
            held = (window[-1:], edge[-1:], at[-1:], hit[-1:])
        if held is not None and held[3][0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(held[1]), pa.array(held[2].astype(np.int16))], ["edge", "at"]
            )

    n = windows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = windows.repartition(int(n), "window").sortWithinPartitions("window")
    return dealt.mapInArrow(run, "edge long, at smallint")


def _cut(docs: DataFrame, with_text: bool) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of texts with their parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = {c: [] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            columns = [batch.column(c) for c in ("doc_id", "packed", "parts")]
            for doc_id, packed, parts in zip(*columns, strict=True):
                data = unpack(packed.as_py())
                edge = np.zeros(len(data) + 1, np.int64)
                if parts.is_valid:
                    first = parts.values.field("first").to_numpy(zero_copy_only=False)
                    end = parts.values.field("end").to_numpy(zero_copy_only=False)
                    np.add.at(edge, first, 1)
                    np.add.at(edge, end, -1)
                gone = np.cumsum(edge)[:-1] > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out["doc_id"].append(doc_id.as_py())
                out["n_bytes"].append(len(data))
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(int((gone[1:] & ~gone[:-1]).sum() + (gone[:1]).sum()))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept if with_text else None)
            names = list(out) if with_text else list(out)[:-1]
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[c], k) for c, k in zip(names, kinds, strict=False)], names
            )

    kinds = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return docs.mapInArrow(run, kinds + ", kept binary" * with_text)


def _packed(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            buf, offsets = text_buffer(batch.column("text"))
            packed = [pack(buf[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array(packed, pa.binary())],
                ["doc_id", "digest", "packed"],
            )

    return _keyed(docs).mapInArrow(run, "doc_id long, digest int, packed binary")


def repeated_windows(docs: DataFrame, options: RepeatOptions, scratch: Scratch) -> DataFrame:
    """(doc_id, digest, first, end): stretches of bytes that repeated windows cover."""
    table = _anchor_table(docs, options)
    twice = table.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    again = scratch.keep(table.join(twice.select("anchor"), "anchor"), "anchors")
    place = F.struct("doc_id", "digest", "first", "n")
    stretches = again.groupBy("anchor", "stretch").agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("place"))
    stretches = scratch.keep(stretches, "stretches")
    whole = again.join(stretches.filter("times > 1").select("anchor", "stretch"), ["anchor", "stretch"])
    found = whole.select("doc_id", "digest", "first", (F.col("first") + F.col("n") - 1 + options.length).alias("end"))
    found = scratch.keep(found, "whole")
    scratch.drop("anchors")
    mixed = stretches.groupBy("anchor").agg(F.min("stretch").alias("lo"), F.max("stretch").alias("hi"), F.min("times").alias("least"))
    edges = stretches.join(mixed.filter("lo <> hi AND least = 1").select("anchor"), "anchor")
    edges = edges.select(F.monotonically_increasing_id().alias("edge"), "anchor", "times", "place.*")
    edges = scratch.keep(edges, "edges")  # written, so each edge keeps its number
    asked = edges.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("first", "n", "anchor", "edge")).alias("asked"))
    rows = _packed(docs).join(asked, ["doc_id", "digest"]).select("packed", "asked")
    hits = _shared(_windows(rows, options))
    hits = hits.join(edges.filter("times = 1").select("edge", "doc_id", "digest", "first"), "edge")
    start = F.col("first") + F.col("at")
    parts = hits.select("doc_id", "digest", start.alias("first"), (start + options.length).alias("end"))
    return found.union(scratch.keep(parts, "parts"))


def remove_repeats(
    docs: DataFrame, options: RepeatOptions | None = None, with_text: bool = False
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of every document; ``kept``
    holds the remaining bytes."""
    options = options or RepeatOptions()
    scratch = Scratch(docs.sparkSession)
    parts = repeated_windows(docs, options, scratch).groupBy("doc_id", "digest")
    parts = parts.agg(F.collect_list(F.struct("first", "end")).alias("parts"))
    return _cut(_packed(docs).join(parts, ["doc_id", "digest"], "left"), with_text)
