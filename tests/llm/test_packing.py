from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from texts_data import SCHEMA, awkward, rows_of
from tokenizers import Tokenizer

from cashcycle.llm.packing import PackOptions, Plan, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("capacity,n,seed", [(10, 40, 1), (50, 300, 2), (97, 5, 3), (4096, 3000, 4), (1, 3, 5)])
def test_plan_places_every_piece_once(capacity, n, seed):
    draw = np.random.default_rng(seed)
    lengths = np.clip(draw.exponential(capacity / 4, n).astype(int) + 1, 1, capacity)
    counts = np.bincount(lengths, minlength=capacity + 1)
    plan = Plan(counts)
    filled = np.zeros(plan.sequences, int)
    for length, _, times, sequence, offset in sorted(plan.table().tolist(), key=lambda r: r[4]):
        assert (filled[sequence : sequence + times] == offset).all()
        filled[sequence : sequence + times] += length
    assert filled.max() <= capacity and filled.min() > 0 and filled.sum() == lengths.sum()
    assert plan.sequences <= -(-int(lengths.sum()) * 11 // (9 * capacity)) + 1


def test_plan_is_optimal_where_pairs_fill():
    counts = np.zeros(11, int)
    counts[[3, 7, 4, 6, 5]] = [4, 4, 2, 2, 3]
    assert Plan(counts).sequences == 8


class Reduced(Plan):
    def _best_fit(self):
        pass


def fewest(pieces, capacity):
    """The smallest number of sequences, by trying all ways."""
    best = len(pieces)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(pieces):
            best = len(rooms)
            return
        for j, room in enumerate(rooms):
            if room >= pieces[k] and room not in rooms[:j]:
                place(k + 1, [*rooms[:j], room - pieces[k], *rooms[j + 1 :]])
        place(k + 1, [*rooms, capacity - pieces[k]])

    place(0, [])
    return best


def test_reduction_keeps_the_fewest_sequences():
    draw = np.random.default_rng(6)
    cases = [(200, [100, 68, 68, 34, 33, 33, 33])]
    cases += [(30, sorted(draw.integers(3, 25, draw.integers(3, 9)).tolist(), reverse=True)) for _ in range(400)]
    for capacity, pieces in cases:
        plan = Reduced(np.bincount(pieces, minlength=capacity + 1))
        rest = np.repeat(np.arange(capacity + 1), plan.left)[::-1].tolist()
        assert plan.sequences + fewest(rest, capacity) == fewest(pieces, capacity), pieces


def test_packing_round_trip(spark, docs):
    tokenizer = Tokenizer.from_file(PATH)
    options = PackOptions(PATH, capacity=256)
    rows = pack(docs, options, with_ids=True).collect()
    want = sorted(tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for _, t, *_ in awkward())
    pieces, filled = {}, {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
        assert r.length == len(r.ids) <= 256 and r.start == 256 * r.piece
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        if r.doc_id != 400:
            pieces.setdefault(r.doc_id, []).append((r.piece, r.ids))
    assert max(filled.values()) <= 256
    got = [tuple(i for _, ids in sorted(p) for i in ids) for p in pieces.values()]
    assert sorted(got) == sorted(set_without_repeats(want, awkward(), tokenizer))


def set_without_repeats(want, rows, tokenizer):
    own = tuple(tokenizer.encode(rows[-1][1], add_special_tokens=False).ids + [1])
    out = list(want)
    out.remove(own)
    out.remove(own)
    return out


def test_words_as_the_tokenizer_has_them(spark):
    texts = ["don't stop, World. it's 3x4", "<|endoftext|> a<|startoftext|>b", "Ärger, ÉTÉ. naïve", "é  x y", "🙂 ok...", "İstanbul ΣΑΣ ß"]
    tokenizer = Tokenizer.from_file(PATH)
    found = pack(spark.createDataFrame(rows_of(enumerate(texts)), SCHEMA), PackOptions(PATH), with_ids=True)
    for r in found.collect():
        assert list(r.ids) == tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids + [1]


def test_empty(empty):
    assert pack(empty, PackOptions(PATH)).count() == 0
