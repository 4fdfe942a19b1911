"""Best-fit packing of tokenized documents after Martello-Toth reduction.

Documents are tokenized, closed by ``end_id`` and cut into pieces of at most ``capacity``
tokens. What a packing depends on is how many pieces there are of each length: a
table of at most ``capacity`` rows at any size of the corpus. The packing is worked out on it:

* reduction: going down the lengths, a set around the longest piece is fixed for good where
  it dominates all others: the piece alone if nothing fits beside it; the piece with the
  largest that fits, if that fills the sequence, if no two other pieces fit beside it,
  or if it is no smaller than the best two that fit and no three other pieces fit;
* best fit: the rest go, longest first, into the fullest sequence that takes them.

Each step handles all pieces of a length together, so the plan is a short list of "pieces
``first`` to ``first + n`` of this length go to sequences from ``sequence`` on, at
``offset``". Pieces get their number within their length from a count per task and length,
and look their place up.

Null and empty texts are one piece with ``end_id`` alone. Repeated rows are packed each
on its own. Rows without ``doc_id`` are left out; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cashcycle.llm.scratch import Scratch
from cashcycle.llm.tables import texts
from cashcycle.llm.textops import chunks
from cashcycle.llm.tokens import encoder


@dataclass(frozen=True)
class PackOptions:
    tokenizer: str
    capacity: int = 4096
    end_id: int = 1


def cut_pieces(docs: DataFrame, options: PackOptions, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, number[, ids]): ``number`` counts a
    task's pieces of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = encoder(options.tokenizer), np.zeros(options.capacity + 1, np.int64)
        task, end = TaskContext.get().partitionId(), np.array([options.end_id], np.uint32)
        for batch in batches:
            for rows, buf, offsets in chunks(batch):
                flat, at = words.encode(buf, offsets)
                out = defaultdict(list)
                ids = rows.column("doc_id").to_pylist()
                for doc_id, lo, hi in zip(ids, at[:-1], at[1:], strict=True):
                    whole = np.concatenate([flat[lo:hi], end])
                    for piece, start in enumerate(range(0, len(whole), options.capacity)):
                        own = whole[start : start + options.capacity]
                        out["doc_id"].append(doc_id)
                        out["piece"].append(piece)
                        out["start"].append(start)
                        out["length"].append(len(own))
                        out["ids_crc32"].append(zlib.crc32(own.astype("<u4").tobytes()))
                        out["number"].append(int(seen[len(own)]))
                        seen[len(own)] += 1
                        if with_ids:
                            out["ids"].append(own.astype(np.int32))
                n = len(out["doc_id"])
                columns = {
                    "doc_id": pa.array(out["doc_id"], pa.int64()),
                    "piece": pa.array(out["piece"], pa.int32()),
                    "start": pa.array(out["start"], pa.int64()),
                    "length": pa.array(out["length"], pa.int64()),
                    "ids_crc32": pa.array(out["ids_crc32"], pa.int64()),
                    "task": pa.array([task] * n, pa.int32()),
                    "number": pa.array(out["number"], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(out["ids"], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long"
    return texts(docs).mapInArrow(run, kinds + (", ids array<int>" if with_ids else ""))


class Plan:
    """Where the pieces of each length go; built from counts by length."""

    def __init__(self, counts: np.ndarray):
        self.capacity = len(counts) - 1
        self.left = counts.astype(np.int64).copy()
        self.used = np.zeros_like(self.left)
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self._reduce()
        self._best_fit()

    def _put(self, length: int, n: int, sequence: int, offset: int) -> None:
        """The next ``n`` pieces of a length go to ``n`` sequences in a row."""
        self.rows.append((length, int(self.used[length]), n, sequence, offset))
        self.used[length] += n
        self.left[length] -= n

    def _open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _best_pair(self, room: int) -> int:
        """The largest sum of two remaining pieces that fit into ``room``; 0 if none."""
        sizes = np.flatnonzero(self.left[: room + 1])
        at = np.searchsorted(sizes, room - sizes, "right") - 1
        same = (at >= 0) & (sizes[at] == sizes) & (self.left[sizes] < 2)
        at = np.where(same, at - 1, at)
        fits = at >= 0
        return int((sizes[fits] + sizes[at[fits]]).max()) if fits.any() else 0

    def _least_three(self) -> int:
        """The sum of the three smallest remaining pieces; beyond the capacity if there are fewer."""
        sizes = np.flatnonzero(self.left)[:3]
        least = np.repeat(sizes, np.minimum(self.left[sizes], 3))[:3]
        return int(least.sum()) if len(least) == 3 else self.capacity + 1

    def _reduce(self) -> None:
        for length in range(self.capacity, 0, -1):
            while self.left[length]:
                room = self.capacity - length
                self.left[length] -= 1  # the piece itself
                beside = np.flatnonzero(self.left[: room + 1])
                partner = int(beside[-1]) if len(beside) else 0
                pair = self._best_pair(room) if partner and partner < room else 0
                dominates = not pair or (partner >= pair and self._least_three() > room)
                self.left[length] += 1
                if not dominates:
                    break
                if not partner:
                    n = int(self.left[length])
                    self._put(length, n, self._open(n), 0)
                else:
                    n = int(self.left[length] // 2 if partner == length else min(self.left[length], self.left[partner]))
                    sequence = self._open(n)
                    self._put(length, n, sequence, 0)
                    self._put(partner, n, sequence, length)

    def _best_fit(self) -> None:
        groups: list[list[tuple[int, int]]] = [[] for _ in range(self.capacity + 1)]
        room_left = np.zeros(self.capacity + 1, bool)

        def add(room: int, group: tuple[int, int]) -> None:
            groups[room].append(group)
            room_left[room] = True

        for length in range(self.capacity, 0, -1):
            while self.left[length]:
                fitting = np.flatnonzero(room_left[length:])
                if len(fitting):
                    room = length + int(fitting[0])
                    sequence, n = groups[room].pop()
                    if not groups[room]:
                        room_left[room] = False
                    take = min(n, int(self.left[length]))
                    self._put(length, take, sequence, self.capacity - room)
                    if room > length:
                        add(room - length, (sequence, take))
                    if take < n:
                        add(room, (sequence + take, n - take))
                    continue
                each = self.capacity // length
                n, rest = divmod(int(self.left[length]), each)
                per, n = (each, n) if n else (rest, 1)
                sequence = self._open(n)
                for k in range(per):
                    self._put(length, n, sequence, k * length)
                if self.capacity > per * length:
                    add(self.capacity - per * length, (sequence, n))

    def table(self) -> np.ndarray:
        """(length, first, n, sequence, offset) in order of length and first."""
        return np.array(sorted(self.rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, options: PackOptions, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of all pieces."""
    spark = docs.sparkSession
    pieces = Scratch(spark).keep(cut_pieces(docs, options, with_ids), "pieces")
    by_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = by_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    counts = np.zeros(options.capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most one row a length
        counts[row.length] = row["count"]
    plan = spark.sparkContext.broadcast(Plan(counts).table())
    placed = pieces.join(by_task.select("task", "length", "before"), ["task", "length"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    placed = placed.select(*columns, (F.col("before") + F.col("number")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = plan.value
        keys = (table[:, 0] << 48) + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << 48) + rank, "right") - 1
            sequence = table[at, 3] + rank - table[at, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(sequence), pa.array(table[at, 4])],
                [*columns, "sequence_id", "offset"],
            )

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long"
    kinds += ", ids array<int>" * with_ids + ", sequence_id long, offset long"
    return placed.mapInArrow(run, kinds)
