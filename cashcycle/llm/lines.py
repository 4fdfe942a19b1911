"""Fuzzy line dedup: MinHash bands of normalised lines, exact letter-count bound, edit similarity.

A line is a run of text between line feeds. It is normalised to its words: letters in
lower case (A-Z and the Latin-1 capitals), digits as they are, everything else of ASCII a
separator. Lines with fewer than ``min_words`` words and fewer than ``min_chars`` characters
are left alone. A line has ``bands`` keys, each of ``band_size`` MinHash values of its words;
lines that share a key are candidates. A changed word of ten leaves 9 of 11 words common, so
nearly half of the keys equal. Candidates are linked when the Levenshtein distance of the
normalised lines is at most ``1 - similarity`` of the longer one.

Before that, pairs are dropped that cannot be that close: an edit changes the length by one at
most, and the counts of characters by two in all. Counts of 32 classes of characters are kept
modulo 8, each as four bits of which neighbouring counts differ in one, so that the bits in which
two lines differ are no more than twice their distance. The bound loses no pair.

Of each connected group the occurrence with the smallest (doc_id, line) stays; equal lines
are one item, so a line that stands in a third of all documents costs one row.

Null and empty texts have no lines and stay as they are. A document that loses all its lines
stays with an empty text. Rows with one ``doc_id`` count as one occurrence of their lines;
rows without an id stay unchanged. ``n_chars``, where there is one, follows the text; other
columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashcycle.llm.edits import close_pairs
from cashcycle.llm.linking import linked_groups
from cashcycle.llm.scratch import Scratch, arrow_rows
from cashcycle.llm.tables import packed_texts_with, texts, unpacked
from cashcycle.llm.textops import chunks, mix, span_hashes, stream, word_spans

@dataclass(frozen=True)
class LineOptions:
    min_words: int = 5
    min_chars: int = 20
    bands: int = 16
    band_size: int = 4
    similarity: float = 0.9


def _normal_bytes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    for code in range(128):
        char = chr(code)
        if char.isalnum():
            table[code] = ord(char.lower())
        else:
            table[code] = 32
    return table


_NORMAL = _normal_bytes()
BOUND = ("size", "low", "high")  # what bounds the edit distance of two lines from below


def normalise(buf: np.ndarray) -> np.ndarray:
    """The same number of bytes, normalised; words are what spaces separate."""
    out = _NORMAL[buf]
    capital = np.flatnonzero(buf[:-1] == 0xC3) + 1
    capital = capital[(buf[capital] >= 0x80) & (buf[capital] <= 0x9E) & (buf[capital] != 0x97)]
    out[capital] += 0x20
    return out


def line_offsets(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of all lines (each with its line feed) and the first line of each document."""
    feeds = np.flatnonzero(buf == 10) + 1
    filled = np.flatnonzero(offsets[1:] > offsets[:-1])
    ends = offsets[filled + 1]
    starts = np.union1d(offsets[filled], feeds[~np.isin(feeds, ends)])
    edges = np.append(starts, len(buf))
    return edges, np.searchsorted(starts, offsets)


def _classes() -> np.ndarray:
    """The class of a character by its last byte: letters, digits modulo 4, others modulo 2; spaces
    have one of their own, the last."""
    table = (30 + np.arange(256) % 2).astype(np.int32)
    table[ord("a") : ord("z") + 1] = np.arange(26)
    table[ord("0") : ord("9") + 1] = 26 + np.arange(10) % 4
    table[ord(" ")] = 32
    return table


_CLASSES = _classes()
# Counts modulo 8, each next to the one before and the last to the first differing in one bit.
_RING = np.array([0b0000, 0b0001, 0b0011, 0b0111, 0b1111, 0b1110, 0b1100, 0b1000], np.uint64)


def letter_counts(text: np.ndarray, edges: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters other than spaces of the lines ``numbers``, and their 128 bits of counts."""
    which = _CLASSES[text]
    more = np.flatnonzero((text[1:] & 0xC0) == 0x80)  # the character goes on
    which[more] = 32
    first = np.zeros(len(edges) - 1, np.int32)  # where a line's counts begin, behind those of no line
    first[numbers] = np.arange(1, len(numbers) + 1) * 33
    which += np.repeat(first, np.diff(edges))  # lines cover the text
    counts = np.bincount(which, minlength=33 * (len(numbers) + 1)).reshape(-1, 33)[1:, :32]
    shifts = np.uint64(4) * np.arange(16, dtype=np.uint64)
    bits = _RING[counts % 8].reshape(len(numbers), 2, 16) << shifts
    return counts.sum(1), np.bitwise_or.reduce(bits, axis=2)


def _band_keys(words: np.ndarray, lengths: np.ndarray, first: np.ndarray, options: LineOptions) -> np.ndarray:
    """32 bits for each line and band, of ``band_size`` MinHash values of the line's words.
    A word of less than four bytes counts together with the next: short ones are common."""
    short = np.flatnonzero(lengths < 4)
    short = short[(short + 1 < len(words)) & ~np.isin(short + 1, first)]
    parts = words.copy()
    parts[short] = mix(words[short] * np.uint64(3) + words[short + 1])
    parts = (parts >> np.uint64(32)).astype(np.uint32)
    n = options.bands * options.band_size
    factor = (stream(32, n) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    shift = (stream(33, n) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(first), options.bands), np.uint32)
    drawn = np.empty_like(parts)
    for band in range(options.bands):
        key = np.full(len(first), band + 1, np.uint64)
        for k in range(band * options.band_size, (band + 1) * options.band_size):
            np.multiply(parts, factor[k], out=drawn)
            drawn += shift[k]
            least = np.minimum.reduceat(drawn, first)
            key = mix(key * np.uint64(0x10001) + least)
        out[:, band] = (key >> np.uint64(32)).astype(np.uint32)
    return out


_CHUNK = 1 << 19  # bytes: what is made of them stays in the processor's cache


def line_features(docs: DataFrame, options: LineOptions) -> DataFrame:
    """(doc_id, line, code, size, low, high, bands...) of all lines that are long enough; a column of
    bands holds two keys of 32 bits."""
    names = band_columns(options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buf, offsets in chunks(batch, limit=_CHUNK):
                edges, first_line = line_offsets(buf, offsets)
                normal = normalise(buf)
                starts, ends, lines = word_spans(normal, edges)
                if not len(starts):
                    continue
                words = span_hashes(normal, starts, ends)
                begin = np.flatnonzero(np.diff(lines, prepend=-1))
                counts = np.diff(np.append(begin, len(lines)))
                numbers = lines[begin]
                place = np.arange(len(words)) - np.repeat(begin, counts)
                factor = stream(31, int(counts.max())) | np.uint64(1)
                codes = mix(np.add.reduceat(words * factor[place], begin) + counts.astype(np.uint64))
                filled, bits = letter_counts(normal, edges, numbers)
                sizes = filled + counts - 1  # with the spaces between words
                documents = np.searchsorted(first_line, numbers, "right") - 1
                bands = np.ascontiguousarray(_band_keys(words, ends - starts, begin, options)).view(np.int64)
                keep = (counts >= options.min_words) | (sizes >= options.min_chars)
                documents = documents[keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id").take(pa.array(documents)),
                        pa.array((numbers[keep] - first_line[documents]).astype(np.int32)),
                        pa.array(codes[keep].view(np.int64)),
                        pa.array(sizes[keep].astype(np.int32)),
                        pa.array(bits[keep, 0].view(np.int64)),
                        pa.array(bits[keep, 1].view(np.int64)),
                        *(pa.array(bands[keep, k]) for k in range(len(names))),
                    ],
                    ["doc_id", "line", "code", *BOUND, *names],
                )

    kinds = "doc_id long, line int, code long, size int, low long, high long" + "".join(f", {name} long" for name in names)
    return texts(docs).mapInArrow(run, kinds)


def band_columns(options: LineOptions) -> list[str]:
    return [f"bands{k}" for k in range(options.bands // 2)]


_HELD = 1 << 16  # lines whose keys a task holds at once
_KEYS_EACH = 1 << 19  # keys of a group, about


def shared_keys(items: DataFrame, options: LineOptions, keys_each: int = _KEYS_EACH) -> DataFrame:
    """(key, id) of the keys that several lines (code, bands...) have: the band's number and its 32 bits.

    Most keys have one line. They travel packed, 12 bytes with the line's code, in groups that
    hold a range of the keys of one band, as many groups as lines need.
    """
    names = band_columns(options)
    ranges = max(1, -(-items.count() // keys_each))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def packed() -> Iterator[pa.RecordBatch]:
            codes, *bands = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("code", *names))
            held.clear()
            for number, two in enumerate(bands):
                for half in (0, 1):
                    low = two.view("<u4")[half::2]
                    part = (low.astype(np.uint64) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
                    order = np.argsort(part, kind="stable")
                    own, first = np.unique(part[order], return_index=True)
                    low, ids = low[order], codes[order]
                    spans = list(zip(first, np.append(first[1:], len(low)), strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own.astype(np.int64) * options.bands + 2 * number + half),
                            pa.array([low[a:b].tobytes() for a, b in spans], pa.binary()),
                            pa.array([ids[a:b].tobytes() for a, b in spans], pa.binary()),
                        ],
                        ["part", "keys", "ids"],
                    )

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= _HELD:
                yield from packed()
        if held:
            yield from packed()

    def several(group: pd.DataFrame) -> pd.DataFrame:
        low = np.frombuffer(b"".join(group["keys"]), "<u4")
        ids = np.frombuffer(b"".join(group["ids"]), np.int64)
        order = np.argsort(low)
        low, ids = low[order], ids[order]
        same = np.zeros(len(low) + 1, bool)
        same[1:-1] = low[1:] == low[:-1]
        there = same[1:] | same[:-1]
        band = int(group["part"].iloc[0]) % options.bands
        return pd.DataFrame({"key": (band << 32) + low[there].astype(np.int64), "id": ids[there]})

    packs = items.select("code", *names).mapInArrow(run, "part long, keys binary, ids binary")
    return packs.groupBy("part").applyInPandas(several, "key long, id long")


def _line_texts(docs: DataFrame) -> DataFrame:
    """(id, words) of the asked-for lines of each row: their normalised text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches):
            ids, words = [], []
            asked = batch.column("asked").to_pylist()
            for text, wanted in zip(batch.column("text").to_pylist(), asked, strict=True):
                lines = text.encode().split(b"\n")
                for want in wanted:
                    if want["line"] >= len(lines):
                        continue  # of another row with this id
                    line = np.frombuffer(lines[want["line"]], np.uint8)
                    ids.append(want["code"])
                    words.append(b" ".join(normalise(line).tobytes().split()).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(words, pa.string())], ["id", "words"])

    return docs.mapInArrow(run, "id long, words string")


PAIRS = 2048  # pairs of lines in a batch
BLOCK = 256  # lines


def _most(sizes: np.ndarray, others: np.ndarray, similarity: float) -> np.ndarray:
    """The edit distance at which lines of these lengths are still linked."""
    return np.floor(np.maximum(sizes, others) * (1 - similarity) + 1e-9).astype(np.int64)


def _close_lines(pairs: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b, wa, wb) whose texts are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            lines = [*batch.column("wa").to_pylist(), *batch.column("wb").to_pylist()]
            sizes = np.array([len(line) for line in lines], np.int64)
            most = _most(sizes[:n], sizes[n:], similarity)
            keep = close_pairs(lines, np.arange(n), np.arange(n, 2 * n), most)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return pairs.mapInArrow(run, "a long, b long")


def _close_members(left: pa.StructArray, right: pa.StructArray, asked: np.ndarray, similarity: float) -> np.ndarray:
    """Which of the pairs asked for are similar enough, by the bound first."""
    size, low, high = ([v.field("bits").field(c).to_numpy() for v in (left, right)] for c in BOUND)
    low, high = ([side.view(np.uint64) for side in half] for half in (low, high))
    most = _most(size[0][:, None], size[1], similarity)
    differ = np.bitwise_count(low[0][:, None] ^ low[1]).astype(np.int64) + np.bitwise_count(high[0][:, None] ^ high[1])
    asked = asked & (np.abs(size[0][:, None] - size[1]) <= most) & (differ <= 2 * most)
    x, y = np.nonzero(asked)
    lines = [*left.field("item").to_pylist(), *right.field("item").to_pylist()]
    asked[x, y] = close_pairs(lines, x, y + len(left), most[x, y])
    return asked


def repeated_lines(docs: DataFrame, options: LineOptions | None = None) -> DataFrame:
    """(doc_id, line) of every occurrence to remove, lines counted from 0."""
    options = options or LineOptions()
    scratch = Scratch(docs.sparkSession)
    features = scratch.keep(line_features(docs, options), "lines")
    lines = features.select("doc_id", "line", "code")
    # the place as one number: with the least of structs Spark would sort all lines
    line, span = F.col("line").cast("decimal(10,0)"), F.lit(1 << 31).cast("decimal(10,0)")
    items = features.withColumn("place", F.col("doc_id").cast("decimal(19,0)") * span + line)
    items = items.groupBy("code").agg(
        F.min("place").alias("place"),
        F.count(F.lit(1)).alias("n"),
        *(F.min(name).alias(name) for name in (*BOUND, *band_columns(options))),
    )
    line = F.pmod("place", span)
    first = F.struct(((F.col("place") - line) / span).cast("long").alias("doc_id"), line.cast("int").alias("line"))
    items = scratch.keep(items.withColumn("first", first).drop("place"), "items")

    tables: dict[str, DataFrame] = {}

    def prepare(ids: DataFrame) -> None:
        ids = scratch.keep(ids.withColumnRenamed("id", "code"), "ids")
        wanted = items.join(ids, "code", "left_semi")
        asked = wanted.groupBy(F.col("first.doc_id").alias("doc_id"))
        asked = asked.agg(F.collect_list(F.struct(F.col("first.line").alias("line"), "code")).alias("asked"))
        tables["words"] = scratch.keep(_line_texts(packed_texts_with(docs, asked)), "words")

    def allowed(one: Column, other: Column) -> Column:
        return F.floor(F.greatest(one, other) * F.lit(1 - options.similarity) + 1e-9).cast("int")

    def check(pairs: DataFrame) -> DataFrame:
        words = tables["words"]
        both = pairs.join(words.select(F.col("id").alias("a"), F.col("words").alias("wa")), "a")
        both = both.join(words.select(F.col("id").alias("b"), F.col("words").alias("wb")), "b")
        return _close_lines(both, options.similarity)

    def payload() -> DataFrame:
        return tables["words"].select("id", F.col("words").alias("item"))

    def compare(left: pa.StructArray, right: pa.StructArray, asked: np.ndarray) -> np.ndarray:
        return _close_members(left, right, asked, options.similarity)

    def close(left: Column, right: Column) -> Column:
        most = allowed(left["size"], right["size"])
        differ = [F.bit_count(left[half].bitwiseXOR(right[half])) for half in ("low", "high")]
        return (F.abs(left["size"] - right["size"]) <= most) & (differ[0] + differ[1] <= 2 * most)

    # bits go with the lines of shared keys only
    bits = items.select(F.col("code").alias("id"), F.struct(*BOUND).alias("bits"))
    keys = scratch.keep(shared_keys(items, options), "shared")
    keys = scratch.keep(keys.join(bits, "id").select("key", "id", "bits"), "keys")
    scratch.drop("shared")
    with arrow_rows(scratch.spark, PAIRS):
        found = linked_groups(scratch, keys, prepare, check, payload, compare, close=close, block=BLOCK)
    scratch.drop("words", "ids", "keys")
    grouped = items.join(found, items.code == found.id, "left")
    grouped = grouped.withColumn("group", F.coalesce("component", "code"))
    kept = grouped.groupBy("group").agg(F.min("first").alias("kept"), F.sum("n").alias("total"))
    kept = grouped.join(kept.filter("total > 1"), "group").select("code", "kept")
    repeated = lines.join(kept, "code").filter(
        (F.col("doc_id") != F.col("kept.doc_id")) | (F.col("line") != F.col("kept.line"))
    )
    return repeated.select("doc_id", "line")


def _unused(name: str, columns: list[str]) -> str:
    """``name``, longer if there is a column of that name in any case."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def remove_repeated_lines(docs: DataFrame, options: LineOptions | None = None) -> DataFrame:
    """``docs`` with one occurrence left of each group of repeated lines."""

    # Texts meet their removals packed: half the bytes to shuffle.
    @F.pandas_udf("binary")
    def packed(text: pd.Series) -> pd.Series:
        pack = zstandard.ZstdCompressor(level=1).compress
        return text.map(lambda t: None if t is None else pack(t.encode("utf-8", "surrogatepass")))

    @F.pandas_udf("string")
    def without(text: pd.Series, removed: pd.Series) -> pd.Series:
        unpack, out = zstandard.ZstdDecompressor().decompress, []
        for data, gone in zip(text, removed, strict=True):
            whole = None if data is None else unpack(data).decode("utf-8", "surrogatepass")
            if whole is not None and gone is not None and len(gone):
                gone = {int(g) for g in gone}
                whole = "\n".join(x for k, x in enumerate(whole.split("\n")) if k not in gone)
            out.append(whole)
        return pd.Series(out, dtype=object)

    own, removed = (_unused(name, docs.columns) for name in ("id_of_removed", "removed"))
    gone = repeated_lines(docs, options).groupBy(F.col("doc_id").alias(own))
    gone = gone.agg(F.collect_set("line").alias(removed))
    columns = [packed("text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    # by a shuffle, as in packed_texts_with
    joined = docs.select(*columns).join(gone.hint("merge"), F.col("doc_id") == F.col(own), "left")
    columns = [without("text", removed).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    out = joined.select(*columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out
