"""Whole batches of texts as byte arrays: words, hashes, shingles.

A batch's texts are one ``uint8`` array with document offsets, so words are found and
hashed by array operations instead of per word. Null texts count as empty. Words are
runs of bytes other than space and \\t\\n\\v\\f\\r, which in UTF-8 never cut a character.
Hashes are 64 bits, fixed for good: the same word has the same hash in every task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20


def give_back() -> None:
    """Returns freed memory, which a worker otherwise keeps for its next tasks, to the system."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers of a seed."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(seed * 0x1000003))


_BYTE = stream(12, 256)
_FOLD = np.arange(256)
_FOLD[65:91] += 32
_BYTE_FOLDED = _BYTE[_FOLD]
_BASE = 0x9F3B1D6A5C27E84D  # odd, so it has an inverse modulo 2**64
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, as long as the longest chunk so far."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES)
        _powers[:] = [
            np.cumprod(np.full(size, b, np.uint64)) for b in (_BASE, pow(_BASE, -1, 1 << 64))
        ]
    return _powers


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its ``n + 1`` offsets; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(
    batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with about ``limit`` bytes of text each: rows, bytes, offsets."""
    if not batch.num_rows:
        return
    buf, offsets = text_buffer(batch.column(column))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield (
            batch.slice(lo, hi - lo),
            buf[offsets[lo] : offsets[hi]],
            offsets[lo : hi + 1] - offsets[lo],
        )
        lo = hi


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and documents of all words."""
    n = len(buf)
    if n == 0:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    ink = (buf != 32) & ((buf - np.uint8(9)) > 4)
    cut = np.zeros(n + 1, bool)  # a document begins here
    cut[offsets] = True
    begins = ink.copy()
    begins[1:] &= ~ink[:-1] | cut[1:n]
    closes = ink.copy()
    closes[:-1] &= ~ink[1:] | cut[1:n]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(closes) + 1
    documents = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, documents


def span_hashes(
    buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False
) -> np.ndarray:
    """Hashes of non-empty spans, from sums of bytes times powers of a base; ``fold``
    takes A-Z as a-z."""
    if not len(starts):
        return np.empty(0, np.uint64)
    power, inverse = _power_tables(len(buf))
    sums = (_BYTE_FOLDED if fold else _BYTE)[buf]
    sums *= power[: len(buf)]
    np.cumsum(sums, out=sums)
    total = sums[ends - 1]
    total -= np.where(starts > 0, sums[starts - 1], np.uint64(0))
    return mix(total * inverse[starts] + (ends - starts).astype(np.uint64))


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Sums of bytes times powers of a base, from which any range can be hashed."""
    power, _ = _power_tables(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * power[: len(buf)], out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ranges of the bytes that ``prefix_sums`` was taken of."""
    _, inverse = _power_tables(len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of a document's ``size``-word shingles in order; with fewer words the
    whole sequence is one; without words there is none."""
    if not len(words):
        return np.empty(0, np.uint64)
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.zeros(n, np.uint64)
    for k, factor in enumerate(stream(13, size) | np.uint64(1)):
        out += words[k : k + n] * factor
    return mix(out + np.uint64(size))


def bounds(documents: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` documents begins in an ordered array of documents."""
    return np.searchsorted(documents, np.arange(n + 1))


def document_shingles(buf: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """The distinct, sorted shingle hashes of each document, A-Z as a-z."""
    starts, ends, documents = word_spans(buf, offsets)
    hashes = span_hashes(buf, starts, ends, fold=True)
    at = bounds(documents, len(offsets) - 1)
    return [
        np.unique(shingle_hashes(hashes[lo:hi], size))
        for lo, hi in zip(at[:-1], at[1:], strict=True)
    ]
