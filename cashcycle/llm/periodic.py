"""Periodic runs: stretches of words that repeat with a period, and texts without the repeats.

A run is a stretch with smallest period ``q`` (words ``q`` apart are the same), at least
``exponent`` periods and ``shortest`` words long, that no word beside it extends. All runs
of a document are found by internal pattern matching over the suffix array of its words:

* dyadic blocks: for each ``L = 1, 2, 4, ...`` the blocks of ``L`` words at multiples of
  ``L``. A run with ``L <= q < 2 L`` and at least three periods holds a block and its copy
  ``q`` words on, so the copy starts in the window of ``L`` words that begins ``L`` after the block;
* occurrences: those of a block are one interval of the suffix array; a wavelet tree over the
  array counts the ones in the window and gives the first after its begin (range successor);
* progressions: a window of ``L`` places holds occurrences in equal steps only, so the
  first two and their number give all. Their distances are the candidate periods. Where the
  step is a period of all words from the block to the last copy, no distance is smallest,
  and the run of that step is found at its own, lower level;
* each candidate is extended both ways by longest common extensions, on the classes of
  equal ``2**k`` words that sorting the suffixes by doubling leaves behind, and kept where it
  is long enough. Of candidates over the same stretch the smallest period stays.

Words that no run can hold are left out first: all three-word sequences of a run occur three
times or more (``exponent`` less one), so stretches of sequences that are rarer are cut out,
and the same is asked again within what is left. This is exact, not a bound on the work.

A document's words lie in one task; tasks take about 1 MB of texts at once, or one longer text.
Nothing is shuffled, so common words and hot sources cost no more than their rows.
Words are the runs of characters other than space and \\t\\n\\v\\f\\r, and are compared by 64-bit
hashes. Null and empty texts have no words and no runs. Repeated rows give repeated results.
Rows without ``doc_id`` are left out; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcycle.llm.tables import texts
from cashcycle.llm.textops import bounds, chunks, mix, span_hashes, stream, word_spans

RESULT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


@dataclass(frozen=True)
class RunOptions:
    exponent: int = 4  # periods, at least
    shortest: int = 6  # words, at least

    def __post_init__(self):
        if self.exponent < 3 or self.shortest < 3:
            raise ValueError("runs have at least three periods and three words")


class WaveletTree:
    """Order statistics of slices of an array of numbers from 0 to ``n - 1``."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros: list[np.ndarray] = []  # zero bits before each place, by level
        for b in range(self.bits - 1, -1, -1):
            one = (values >> b) & 1 == 1
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate([values[~one], values[one]])

    def below(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many numbers in [lo, hi) are smaller than ``value``."""
        found = np.where(value >= 1 << self.bits, hi - lo, 0)
        inside = value < 1 << self.bits
        for level, before in enumerate(self.zeros):
            one = (value >> (self.bits - 1 - level)) & 1 == 1
            a, b = before[lo], before[hi]
            found += np.where(one & inside, b - a, 0)
            lo = np.where(one, before[-1] + lo - a, a)
            hi = np.where(one, before[-1] + hi - b, b)
        return found

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The number with ``k`` smaller ones in [lo, hi)."""
        value, k = np.zeros(len(lo), np.int64), k.copy()
        for before in self.zeros:
            a, b = before[lo], before[hi]
            one = k >= b - a
            k -= np.where(one, b - a, 0)
            lo = np.where(one, before[-1] + lo - a, a)
            hi = np.where(one, before[-1] + hi - b, b)
            value = 2 * value + one
        return value


class Suffixes:
    """Classes of equal stretches of ``2**k`` symbols, and the suffix array they end in."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        own = np.unique(symbols, return_inverse=True)[1]
        self.classes = [np.append(own, -1).astype(np.int32)]  # the place behind the end equals none
        while own.max() < n - 1:
            step = 1 << (len(self.classes) - 1)
            after = np.zeros(n, np.int64)
            after[: max(0, n - step)] = own[step:] + 1
            own = np.unique(own * (n + 1) + after, return_inverse=True)[1]
            self.classes.append(np.append(own, -1).astype(np.int32))
        self.array = np.empty(n, np.int64)
        self.array[own] = np.arange(n)

    def after(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols are equal from x and from y > x on."""
        x, y = x.copy(), y.copy()
        begin = y.copy()
        for k in range(len(self.classes) - 1, -1, -1):
            same = self.classes[k][x] == self.classes[k][y]
            x += same * (1 << k)
            y += same * (1 << k)
        return y - begin

    def before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many symbols are equal backwards from x - 1 and from y - 1."""
        x, y = x.copy(), y.copy()
        end = y.copy()
        for k in range(len(self.classes) - 1, -1, -1):
            room = x >= 1 << k
            back = np.where(room, 1 << k, 0)
            same = room & (self.classes[k][x - back] == self.classes[k][y - back])
            x -= same * (1 << k)
            y -= same * (1 << k)
        return end - y


_AT_ONCE = 1 << 19


def _candidates(suffixes: Suffixes, tree: WaveletTree, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of ``2**k`` symbols and the distances of their copies in the next window."""
    n, size = len(suffixes.array), 1 << k
    blocks = np.arange(0, n - 2 * size + 1, size)
    first = np.append(0, np.cumsum(np.bincount(suffixes.classes[k][:n])))
    own = suffixes.classes[k][blocks]
    blocks, own = blocks[first[own + 1] - first[own] > 1], own[first[own + 1] - first[own] > 1]
    lo, hi = first[own], first[own + 1]
    skipped = tree.below(lo, hi, blocks + size)
    found = tree.below(lo, hi, blocks + 2 * size) - skipped
    some = found > 0
    blocks, lo, hi, skipped, found = blocks[some], lo[some], hi[some], skipped[some], found[some]
    nearest = tree.smallest(lo, hi, skipped)
    step = np.ones(len(blocks), np.int64)
    more = found > 1
    step[more] = tree.smallest(lo[more], hi[more], skipped[more] + 1) - nearest[more]
    many = found > 2
    last = nearest + (found - 1) * step + size
    through = blocks[many] + step[many] + suffixes.after(blocks[many], blocks[many] + step[many])
    smaller = np.zeros(len(blocks), bool)
    smaller[many] = through >= last[many]
    blocks, nearest, step, found = blocks[~smaller], nearest[~smaller], step[~smaller], found[~smaller]
    if not len(blocks):
        return
    closing = np.cumsum(found)
    cuts = np.unique(np.searchsorted(closing, np.arange(0, found.sum(), _AT_ONCE), "right"))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(found)], strict=True):
        times = found[a:b]
        number = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        block = np.repeat(blocks[a:b], times)
        yield block, np.repeat(nearest[a:b], times) + number * np.repeat(step[a:b], times) - block


def runs_of(symbols: np.ndarray, options: RunOptions = RunOptions()) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period. The last symbol must
    occur once; a symbol that occurs once parts what is before it from what is behind."""
    if len(symbols) < 4:
        return np.empty((0, 3), np.int64)
    suffixes = Suffixes(symbols)
    tree = WaveletTree(suffixes.array)
    rows = []
    for k in range(len(suffixes.classes)):
        if options.exponent << k > len(symbols):
            break
        for block, period in _candidates(suffixes, tree, k):
            start = block - suffixes.before(block, block + period)
            end = block + period + suffixes.after(block, block + period)
            length = end - start
            long = length >= np.maximum(options.shortest, options.exponent * period)
            rows.append(np.unique(np.stack([start, length, period], axis=1)[long], axis=0))
    found = np.unique(np.concatenate(rows), axis=0) if rows else np.empty((0, 3), np.int64)
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    return found[new]


def _stretches(words: np.ndarray, group: np.ndarray, options: RunOptions) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches whose three-word sequences are frequent enough
    within their group for a run; groups are consecutive."""
    if len(words) < options.shortest:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    least = min(options.exponent - 1, max(options.exponent, options.shortest) - 2)
    a, b, c, d = stream(31, 4) | np.uint64(1)
    key = mix(words[:-2] * a + words[1:-1] * b + words[2:] * c + group[:-2].astype(np.uint64) * d)
    inside = group[:-2] == group[2:]
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    good = inside & (count[which] >= least)
    joined = np.zeros(len(good) + 1, bool)
    joined[1:-1] = good[1:] & good[:-1] & (group[1:-2] == group[:-3])
    starts = np.flatnonzero(good & ~joined[:-1])
    ends = np.flatnonzero(good & ~joined[1:]) + 3
    enough = ends - starts >= options.shortest
    return starts[enough], ends[enough]


def document_runs(words: np.ndarray, documents: np.ndarray, options: RunOptions = RunOptions()) -> np.ndarray:
    """Rows (start, length, period) of the runs in consecutive documents' word hashes."""
    place, group = np.arange(len(words)), documents
    for _ in range(3):
        starts, ends = _stretches(words[place], group, options)
        sizes = ends - starts
        if not len(sizes):
            return np.empty((0, 3), np.int64)
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        group = np.repeat(np.arange(len(sizes)), sizes)
        before, place = len(place), place[np.repeat(starts, sizes) + within]
        if len(place) == before:
            break
    symbols = np.unique(words[place], return_inverse=True)[1]
    at = np.cumsum(sizes)  # a symbol of its own closes each stretch
    closed = np.insert(symbols, at, symbols.max() + 1 + np.arange(len(sizes)))
    back = np.insert(place, at, 0)
    runs = runs_of(closed, options)
    runs[:, 0] = back[runs[:, 0]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapsed(text: bytes, runs: np.ndarray) -> bytes:
    """The words outside the repeats, joined by one space."""
    words = text.split()
    if len(runs):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    return b" ".join(words)


def find_runs(docs: DataFrame, options: RunOptions = RunOptions()) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): ``runs`` by start, then period; ``collapsed`` is the
    text without words that lie in a run behind its first period, joined by single spaces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buf, offsets in chunks(batch):
                starts, ends, which = word_spans(buf, offsets)
                edges = bounds(which, rows.num_rows)
                runs = document_runs(span_hashes(buf, starts, ends), which, options)
                owner = which[runs[:, 0]] if len(runs) else np.empty(0, np.int64)
                own = bounds(owner, rows.num_rows)
                runs[:, 0] -= edges[owner]
                data, out = buf.tobytes(), []
                for k, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    out.append(_collapsed(data[lo:hi], runs[own[k] : own[k + 1]]))
                fields = [pa.array(runs[:, c].copy(), pa.int64()) for c in range(3)]
                structs = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(own, pa.int32()), structs)
                collapsed = pa.array(out, pa.binary()).cast(pa.string())
                columns = [rows.column("doc_id"), pa.array(np.diff(edges)), lists, collapsed]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return texts(docs).mapInArrow(run, RESULT)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """The documents with known runs put in, for tests of the search: where ``h``, the
    crc32 of the id as text, is a multiple of 10, each word from ``a`` on becomes word
    ``a + (i - a) % p``, with ``g = h div 10``, ``a = g % n`` and ``p = 1 + (n - a) div (3 + g % 8)``."""
    rows = texts(docs).withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    chosen = F.col("h") % 10 == 0
    rows = rows.withColumn("words", F.when(chosen, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    rows = rows.withColumn("n", n.cast("long")).withColumn("g", g.cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = "slice(flatten(array_repeat(slice(words, int(a + 1), int(p)), int((n - a + p - 1) div p))), 1, int(n - a))"
    altered = F.expr(f"concat_ws(' ', slice(words, 1, int(a)), {tail})")
    return rows.select("doc_id", F.when(F.col("n") > 0, altered).otherwise(F.col("text")).alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)."""
    best = F.expr("array_max(transform(runs, r -> named_struct('l', r.length, 's', -r.start, 'p', -r.period)))")
    lines = F.expr(r"array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.l div -best.p").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
