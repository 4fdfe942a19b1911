"""Token ids by the bounded word table, and means over many trainers."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from texts_data import awkward, prose
from tokenizers import Tokenizer

from cashcycle.llm import attention, scoring
from cashcycle.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = "Été, ÉTÉ été. ÀÖØÞßÿ ×a ÷b a×b x÷, foo.. ,, . , .a a,b İstanbul ΣΑΣ, ĀB naïve's 12. 3,4 日本, éte don't It's, </w> A"


def buffer(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    parts = [t.encode() for t in texts]
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])


@pytest.mark.parametrize("slots,kept_ids", [(1 << 20, 6_000_000), (7, 6_000_000), (1, 50), (64, 0)])
def test_ids_are_the_tokenizers_whatever_the_table_holds(slots, kept_ids):
    tokenizer, words = Tokenizer.from_file(PATH), WordEncoder(PATH, slots, kept_ids)
    texts = [t or "" for _, t, *_ in awkward()] + [ODD, "", prose(1, 300), ODD.upper(), " \n", prose(1, 300).title()]
    for part in (texts, texts[::-1], [""], [], texts):
        ids, at = words.encode(*buffer(part))
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in part]
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == want
        assert words.used <= kept_ids + sum(map(len, want))


def test_each_token_is_in_one_window_and_chosen_windows_are_the_same_in_any_blocks():
    options = attention.AttentionOptions(context=3, scored=4)
    ids, edges = np.arange(100, 123, dtype=np.uint32), np.array([0, 9, 9, 23])

    def rows(at_once, chosen=None):
        return [(o, t) for token, owner in attention.window_tokens(ids, edges, 7, options, chosen, at_once)
                for o, t in zip(owner.tolist(), token.tolist(), strict=True)]

    for document in range(3):
        scored = [t for o, token in rows(2) if o == document for t in token[3:] if t != -1]
        assert scored == [*ids[edges[document] : edges[document + 1]], 7]
    assert rows(1) == rows(2) == rows(100) and rows(5)[0][1][:3] == [-2, -2, -2]
    odd = lambda owner, number: number % 2 == 1
    assert rows(1, odd) == rows(100, odd) == [r for r in rows(100) if r[1][3] in (104, 113, 121)]


def test_mean_of_many_trainers_in_two_steps(spark):
    draw = np.random.default_rng(1)
    weights = draw.random((100, 2, 5))
    rows = [(p, k % 10, 1, bytearray(weights[k, p].tobytes())) for k in range(100) for p in range(2)]
    trained = spark.createDataFrame(rows, "part int, bucket int, n long, weights binary")
    for trainers in (10, 100):
        found = sorted((r.part, r.n, r.weights) for r in scoring._mean(trained, trainers).collect())
        assert [(p, n) for p, n, _ in found] == [(0, 100), (1, 100)]
        assert np.allclose([np.frombuffer(w) / n for _, n, w in found], weights.mean(0))
