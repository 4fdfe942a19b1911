"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Seeds are all of an item's ``gram``-word n-grams (A-Z as a-z); an item of fewer words is one
seed. None is dropped for being common: how often a seed occurs says nothing about a leak
beside it. A pass over the documents finds the seeds in each, joins what overlaps to one
window an item, drops windows that share too few words with the item to reach the score,
aligns the others with the item's words (match 2, mismatch and gap -1) and reports the best alignment that
scores at least ``share`` of what the whole item would.

The benchmark is taken in slices of about ``slice_chars`` characters, each broadcast to the
tasks that read the documents; a larger benchmark takes more passes. Documents are
never shuffled.

Null and empty texts, on either side, match nothing. Rows with one ``doc_id`` (or
``item_id``) are reported under it, the best alignment once. Rows without an id are left
out of the report; ``without_leaks`` keeps them. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcycle.llm.scratch import Scratch
from cashcycle.llm.tables import texts
from cashcycle.llm.textops import bounds, chunks, mix, shingle_hashes, span_hashes, stream, word_spans


@dataclass(frozen=True)
class LeakOptions:
    gram: int = 4
    share: float = 0.5
    slice_chars: int = 4_000_000


MATCH = 2
_FILTER_BITS = 20


class Seeds:
    """Sorted seed hashes with a small filter in front."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self._slot(self.hashes)] = True

    @staticmethod
    def _slot(x: np.ndarray) -> np.ndarray:
        return (x & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``grams`` that are seeds, and which."""
        maybe = np.flatnonzero(self.filter[self._slot(grams)])
        place = np.searchsorted(self.hashes, grams[maybe])
        place[place == len(self.hashes)] = 0
        hit = self.hashes[place] == grams[maybe] if len(self.hashes) else np.zeros(0, bool)
        return maybe[hit], place[hit]


def _windows(words: np.ndarray, documents: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word runs within a document, and where they begin."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = np.flatnonzero(documents[:n] == documents[size - 1 :])
    total = np.zeros(n, np.uint64)
    for k, factor in enumerate(stream(13, size) | np.uint64(1)):
        total += words[k : k + n] * factor
    return mix(total + np.uint64(size))[inside], inside


def align(text: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman score of two word sequences, and where the best alignment lies in
    ``text``: first word, one past the last. Ties go to the earliest end."""
    columns = np.arange(len(text) + 1)
    score = np.zeros(len(text) + 1, np.int64)
    origin = columns.copy()
    best, where = 0, (0, 0)
    for word in item:
        step = np.where(text == word, MATCH, -1)
        down, cross = score - 1, score[:-1] + step
        new, start = down.copy(), origin.copy()
        better = cross >= new[1:]
        new[1:] = np.where(better, cross, new[1:])
        start[1:] = np.where(better, origin[:-1], start[1:])
        empty = new <= 0
        new[empty] = 0
        start[empty] = columns[empty]
        # a gap in the item: carry the best score to the right, one less for each word
        lifted = new + columns
        running = np.maximum.accumulate(lifted)
        fresh = np.flatnonzero(lifted == running)
        source = fresh[np.searchsorted(fresh, columns, "right") - 1]
        carried = running - columns
        longer = carried > new
        score = np.where(longer, carried, new)
        origin = np.where(longer, start[source], start)
        top = int(score.argmax())
        if score[top] > best:
            best, where = int(score[top]), (int(origin[top]), top)
    return best, *where


def _words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, documents = word_spans(buf, offsets)
    return span_hashes(buf, starts, ends, fold=True), documents


@dataclass
class Item:
    item_id: int
    words: np.ndarray
    grams: np.ndarray

    def __post_init__(self):
        self.kinds, self.times = np.unique(self.words, return_counts=True)


def _items(rows: pa.Table, gram: int) -> list[Item]:
    found = []
    for batch in rows.to_batches():
        for part, buf, offsets in chunks(batch):
            words, documents = _words(buf, offsets)
            at = bounds(documents, len(offsets) - 1)
            for item_id, lo, hi in zip(part.column("item_id").to_pylist(), at[:-1], at[1:], strict=True):
                if hi > lo:
                    own = words[lo:hi]
                    found.append(Item(item_id, own, shingle_hashes(own, gram)))
    return found


def _slices(benchmark: DataFrame, options: LeakOptions) -> Iterator[list[Item]]:
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    items = items.filter("item_id IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // options.slice_chars)
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k)
        yield _items(part.toArrow(), options.gram)


def _windows_of(places: list[int], length: int, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """Stretches of a document, from ``lo`` to ``hi``, in which an item of ``length`` words
    may lie that would begin at one of ``places``; those that overlap are one."""
    first, last = None, 0
    for begin in sorted(places):
        a, b = max(lo, begin - length // 2), min(hi, begin + 2 * length)
        if first is not None and a <= last:
            last = max(last, b)
            continue
        if first is not None:
            yield first, last
        first, last = a, b
    if first is not None:
        yield first, last


def most_common(text: np.ndarray, item: Item) -> int:
    """How many words an alignment can match at most: those both have, with repeats."""
    place = np.searchsorted(item.kinds, text)
    place[place == len(item.kinds)] = 0
    seen = np.bincount(place[item.kinds[place] == text], minlength=len(item.kinds))
    return int(np.minimum(seen, item.times).sum())


def _find(docs: DataFrame, shared, sizes: list[int], options: LeakOptions) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, owners, items = shared.value
        for batch in batches:
            for rows, buf, offsets in chunks(batch):
                words, documents = _words(buf, offsets)
                at = bounds(documents, len(offsets) - 1)
                asked: dict[tuple[int, int], list[int]] = defaultdict(list)
                for size in sizes:
                    grams, begin = _windows(words, documents, size)
                    hits, which = seeds.find(grams)
                    for place, seed in zip(begin[hits].tolist(), which.tolist(), strict=True):
                        for item, inside in owners[seed]:
                            asked[int(documents[place]), item].append(place - inside)
                found: dict[tuple[int, int], tuple] = {}
                for (document, item), places in asked.items():
                    length = len(items[item].words)
                    lo, hi = at[document], at[document + 1]
                    for a, b in _windows_of(places, length, lo, hi):
                        if most_common(words[a:b], items[item]) < options.share * length:
                            continue
                        score, first, last = align(words[a:b], items[item].words)
                        if score >= options.share * MATCH * length:
                            row = (score, first + a - lo, last + a - lo)
                            if row[0] > found.get((document, item), (0,))[0]:
                                found[document, item] = row
                if not found:
                    continue
                ids = rows.column("doc_id").to_pylist()
                out = [
                    (ids[d], items[i].item_id, s / (MATCH * len(items[i].words)), s, f, e)
                    for (d, i), (s, f, e) in found.items()
                ]
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "item_id", "similarity", "score", "first_word", "last_word"]
                )

    return texts(docs).mapInArrow(
        run,
        "doc_id long, item_id long, similarity double, score long, first_word long, last_word long",
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame, options: LeakOptions | None = None) -> DataFrame:
    """(doc_id, item_id, similarity, score, first_word, last_word): the best alignment of
    each document and test item that reaches ``share``; words are counted from 0, the
    last one is exclusive."""
    options = options or LeakOptions()
    spark = docs.sparkSession
    scratch = Scratch(spark)
    parts = []
    for items in _slices(benchmark, options):
        if not items:
            continue
        sizes = sorted({min(options.gram, len(i.words)) for i in items})
        owners: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for number, item in enumerate(items):
            for inside, gram in enumerate(item.grams.tolist()):
                owners[gram].append((number, inside))
        seeds = Seeds(np.array(sorted(owners), np.uint64))
        shared = (seeds, [owners[int(h)] for h in seeds.hashes], items)
        found = _find(docs, spark.sparkContext.broadcast(shared), sizes, options)
        parts.append(scratch.keep(found, f"leaks{len(parts)}"))
    if not parts:
        kinds = "doc_id long, item_id long, similarity double, score long, first_word long, last_word long"
        return spark.createDataFrame([], kinds)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    best = F.max(F.struct("score", -F.col("first_word"), "last_word", "similarity")).alias("best")
    whole = whole.groupBy("doc_id", "item_id").agg(best)
    return whole.select(
        "doc_id",
        "item_id",
        "best.similarity",
        "best.score",
        (-F.col("best.col2")).alias("first_word"),
        "best.last_word",
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, options: LeakOptions | None = None) -> DataFrame:
    """``docs`` without the documents that hold a test item."""
    leaks = find_leaks(docs, benchmark, options).select(F.col("doc_id").alias("__leak")).distinct()
    return docs.join(leaks, F.col("doc_id") == F.col("__leak"), "left_anti")
