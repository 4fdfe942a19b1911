"""Ranked lexical search the other way round: documents stream past an index of the items.

The queries (items) are few and the documents many, so the inverted index is built over the
items' terms and broadcast, and the documents are read once:

1. each document's terms are looked up in the items' vocabulary; its term counts that any
   item asks for are written, with the task's share of the document frequencies and totals
   (one row a task, so there is no shuffle but of these sums);
2. the counts stream through the postings: a batch of documents is scored against all items
   of the block at once, and each task keeps a heap of the ``top`` best documents an item;
3. the tasks' heaps are merged by a ranking of each item's at most ``top`` rows a task.

Terms are runs of ASCII letters, digits and all other code points from U+0080 on, A-Z as a-z.
A term with weight ``w`` adds ``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` for each time the
item has it, where ``m`` is 25 for an empty document and 100 for one of average length; see
``weight`` and ``lengths``. Terms meet by 64-bit hashes.

The broadcast index holds at most ``block_postings`` postings (a single item may have more).
With more, items are dealt to blocks by their id, and the documents are read for each block.
The number of scoring tasks follows the cluster, so heaps do not multiply with the input.

Rows without ``doc_id`` or ``item_id`` are left out; other columns are ignored. A null or
empty text has no terms: such a document does not count, such an item finds nothing. Each
row of the documents is one document, so a repeated row is found as often as it is there,
with its own rank. Of items with the same id the smallest text counts. Ties are ordered by
ascending ``doc_id``.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cashcycle.llm.scratch import Scratch
from cashcycle.llm.tables import texts
from cashcycle.llm.textops import bounds, chunks, span_hashes

RESULT = "item_id long, rank int, doc_id long, score long"
_COUNTS = "doc_id long, docs long, terms_of long, terms array<int>, counts array<int>"

_PAIRS = 1 << 20  # of a document's term and an item, at once

_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True


@dataclass(frozen=True)
class SearchOptions:
    top: int = 10
    block_postings: int = 1_000_000
    cells: int = 2_000_000  # scores held at once: items of the block times documents


def term_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and documents of all terms."""
    if not len(buf):
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    ink = _TERM[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[offsets] = True
    begins, closes = ink.copy(), ink.copy()
    begins[1:] &= ~ink[:-1] | cut[1:-1]
    closes[:-1] &= ~ink[1:] | cut[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(offsets, starts, "right") - 1


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def lengths(terms_of: list[int], n_docs: int, all_terms: int) -> np.ndarray:
    """``m`` of documents with so many terms, in whole numbers of any size."""
    return np.array([25 + 75 * n * n_docs // all_terms for n in terms_of], np.int64)


def _lists(values: np.ndarray, edges: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values, pa.int32()))


def item_postings(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of the items' terms; ``term`` is the hash as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buf, offsets in chunks(batch):
                starts, ends, which = term_spans(buf, offsets)
                hashes = span_hashes(buf, starts, ends, fold=True)
                order = np.lexsort((hashes, which))
                hashes, which = hashes[order], which[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (which[1:] != which[:-1])
                at = np.flatnonzero(new)
                times = np.diff(np.append(at, len(hashes)))
                ids = rows.column("item_id").take(pa.array(which[at]))
                terms = pa.array(hashes[at].view(np.int64))
                yield pa.RecordBatch.from_arrays([ids, terms, pa.array(times, pa.int64())], ["item_id", "term", "times"])

    named = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    one = named.filter("item_id IS NOT NULL").groupBy("item_id").agg(F.min("text").alias("text"))
    return one.mapInArrow(run, "item_id long, term long, times long")


class Index:
    """The postings of one block of items, term by term."""

    def __init__(self, item_id: np.ndarray, term: np.ndarray, times: np.ndarray):
        self.items, place = np.unique(item_id, return_inverse=True)
        order = np.lexsort((place, term))
        self.vocabulary, first = np.unique(term[order], return_index=True)
        self.first = np.append(first, len(term))
        self.place, self.times = place[order], times[order]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The terms' places in the vocabulary, -1 where no item has them."""
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at, -1)


def blocks(postings: DataFrame, limit: int) -> Iterator[Index]:
    """Indexes of at most ``limit`` postings each, as far as an item is not larger itself."""
    sizes = postings.groupBy("item_id").count()
    total, n_items = sizes.agg(F.sum("count"), F.count("*")).first()
    n = max(1, -(-(total or 0) // limit))
    block = F.lit(0)
    while n > 1:
        block = F.pmod(F.xxhash64("item_id"), F.lit(n))
        most = sizes.groupBy(block.alias("block")).agg(F.sum("count").alias("n"), F.count("*").alias("items"))
        if most.filter((F.col("n") > limit) & (F.col("items") > 1)).isEmpty() or n > 8 * n_items:
            break
        n *= 2
    for k in range(n):
        table = postings.filter(block == k).toArrow()
        if table.num_rows:
            yield Index(*(table.column(c).to_numpy() for c in ("item_id", "term", "times")))


def term_counts(docs: DataFrame, index: Index) -> DataFrame:
    """Counts of the index's terms in each document that has any; and for each task a row
    without ``doc_id`` of its documents, their terms, and its documents with each term."""
    shared = docs.sparkSession.sparkContext.broadcast(index.vocabulary)
    names = ["doc_id", "docs", "terms_of", "terms", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Index.__new__(Index)
        own.vocabulary = shared.value
        df, n_docs, n_terms = np.zeros(len(own.vocabulary), np.int64), 0, 0
        for batch in batches:
            for rows, buf, offsets in chunks(batch):
                starts, ends, which = term_spans(buf, offsets)
                sizes = np.bincount(which, minlength=rows.num_rows)
                n_docs, n_terms = n_docs + int((sizes > 0).sum()), n_terms + len(which)
                found = own.find(span_hashes(buf, starts, ends, fold=True).view(np.int64))
                hit = found >= 0
                pairs, times = np.unique(which[hit] * len(df) + found[hit], return_counts=True)
                document, term = np.divmod(pairs, len(df))
                df += np.bincount(term, minlength=len(df))
                with_any = np.unique(document)
                edges = np.append(bounds(document, rows.num_rows)[with_any], len(document))
                ids = rows.column("doc_id").take(pa.array(with_any))
                ones = pa.array(np.ones(len(with_any), np.int64))
                of = pa.array(sizes[with_any].astype(np.int64))
                yield pa.RecordBatch.from_arrays([ids, ones, of, _lists(term, edges), _lists(times, edges)], names)
        some = np.flatnonzero(df)
        edges = np.array([0, len(some)])
        totals = [pa.array([None], pa.int64()), pa.array([n_docs]), pa.array([n_terms])]
        yield pa.RecordBatch.from_arrays([*totals, _lists(some, edges), _lists(df[some], edges)], names)

    return texts(docs).mapInArrow(run, _COUNTS)


def _statistics(counts: DataFrame, index: Index) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and the weight of each term of the index."""
    rows = counts.filter("doc_id IS NULL")
    n_docs, all_terms = rows.agg(F.sum("docs"), F.sum("terms_of")).first()
    zipped = rows.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    table = zipped.groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("df")).toArrow()
    df = np.zeros(len(index.vocabulary), np.int64)
    df[table.column("term").to_numpy()] = table.column("df").to_numpy()
    weights = np.array([weight(n_docs or 0, d) for d in df.tolist()], np.int64)
    return n_docs or 0, all_terms or 0, weights


class Heaps:
    """The best documents of each item so far."""

    def __init__(self, n: int, top: int):
        self.top, self.heaps = top, [[] for _ in range(n)]
        self.least = np.ones(n, np.int64)  # the score that still gets in

    def update(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of all items (rows) and of documents ``ids`` (columns)."""
        item, column = np.nonzero(scores >= self.least[:, None])
        edges = bounds(item, len(self.heaps))
        for k in np.unique(item).tolist():
            at = column[edges[k] : edges[k + 1]]
            own = scores[k, at]
            best = np.lexsort((ids[at], -own))[: self.top]
            heap = self.heaps[k]
            for entry in zip(own[best].tolist(), (-ids[at[best]]).tolist(), strict=True):
                if len(heap) < self.top:
                    heapq.heappush(heap, entry)
                else:
                    heapq.heappushpop(heap, entry)
            if len(heap) == self.top:
                self.least[k] = heap[0][0]


def best_of_tasks(counts: DataFrame, index: Index, options: SearchOptions) -> DataFrame:
    """(item_id, doc_id, score): each task's best documents of each item."""
    n_docs, all_terms, weights = _statistics(counts, index)
    context = counts.sparkSession.sparkContext
    shared = context.broadcast((index, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weights = shared.value
        heaps = Heaps(len(index.items), options.top)
        at_once = max(1, options.cells // max(1, len(index.items)))
        for batch in batches:
            for lo in range(0, batch.num_rows, at_once):
                rows = batch.slice(lo, at_once)
                _score(rows, index, weights, n_docs, all_terms, heaps)
        found = [(i, -d, s) for i, heap in zip(index.items.tolist(), heaps.heaps, strict=True) for s, d in heap]
        columns = [pa.array([f[k] for f in found], pa.int64()) for k in range(3)]
        yield pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score"])

    rows = counts.filter("doc_id IS NOT NULL").select("doc_id", "terms_of", "terms", "counts")
    rows = rows.coalesce(max(1, 2 * context.defaultParallelism))
    return rows.mapInArrow(run, "item_id long, doc_id long, score long")


def _score(rows: pa.RecordBatch, index: Index, weights: np.ndarray, n_docs: int, all_terms: int, heaps: Heaps) -> None:
    """Scores documents against all items of the index and keeps the best."""
    terms, times = rows.column("terms"), rows.column("counts").flatten().to_numpy().astype(np.int64)
    which = np.repeat(np.arange(rows.num_rows), terms.value_lengths().to_numpy())
    term = terms.flatten().to_numpy()
    m = lengths(rows.column("terms_of").to_pylist(), n_docs, all_terms)[which]
    gain = weights[term] * (1_000_000_000 * times // (1000 * times + 8 * m))
    width, n_postings = rows.num_rows, index.first[term + 1] - index.first[term]
    scores, closing = np.zeros((len(index.items), width), np.int64), np.cumsum(n_postings)
    cuts = np.unique(np.searchsorted(closing, np.arange(0, n_postings.sum(), _PAIRS), "right"))
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(term)], strict=True):
        n = n_postings[lo:hi]
        at = np.arange(n.sum()) + np.repeat(index.first[term[lo:hi]] - np.cumsum(n) + n, n)
        cell = index.place[at] * width + np.repeat(which[lo:hi], n)
        np.add.at(scores.reshape(-1), cell, index.times[at] * np.repeat(gain[lo:hi], n))
    heaps.update(scores, rows.column("doc_id").to_numpy())


def search(docs: DataFrame, items: DataFrame, options: SearchOptions = SearchOptions()) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's best documents, from rank 1."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    postings, parts = scratch.keep(item_postings(items), "search-postings"), []
    for k, index in enumerate(blocks(postings, options.block_postings)):
        counts = scratch.keep(term_counts(docs, index), "search-counts")
        parts.append(scratch.keep(best_of_tasks(counts, index, options), f"search-best-{k}"))
        scratch.drop("search-counts")
    scratch.drop("search-postings")
    if not parts:
        return spark.createDataFrame([], RESULT)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = reduce(DataFrame.unionAll, parts).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= options.top).select("item_id", "rank", "doc_id", "score")
