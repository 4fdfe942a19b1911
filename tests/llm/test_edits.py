from __future__ import annotations

import random

import numpy as np
from test_lines import edit_distance
from texts_data import prose

from cashcycle.llm.edits import close_pairs


def test_against_the_whole_table():
    draw = random.Random(6)
    texts = ["", "a", "b", "ab", "ba", "é漢", "漢é\U0001f600"]
    for k in range(40):
        text = list(prose(k, draw.randrange(1, 14)))
        texts.append("".join(text))
        for _ in range(draw.randrange(9)):
            text[draw.randrange(len(text))] = draw.choice(["", "zz", "é", "漢", "x"])
        texts.append("".join(text))
    left, right = (x.reshape(-1) for x in np.meshgrid(range(len(texts)), range(len(texts))))
    real = np.array([edit_distance(texts[a], texts[b]) for a, b in zip(left, right, strict=True)])
    for most in (np.zeros(len(left), int), real, np.maximum(real - 1, 0), real // 2 + np.arange(len(left)) % 7):
        assert (close_pairs(texts, left, right, most) == (real <= most)).all()


def test_long_texts():
    text = prose(3, 9000)
    other = text[:20_000] + "zz" + text[20_003:]
    pair = np.array([0]), np.array([1])
    assert len(text) > 30_000
    assert [bool(close_pairs([text, other], *pair, np.array([k]))[0]) for k in (1, 2, 3, 4)] == [False, False, True, True]


def test_many_different_texts_in_several_batches():
    texts = [prose(k, 100) for k in range(200)] + [prose(k, 100) + "x" for k in range(200)]
    left, right = (x.reshape(-1) for x in np.meshgrid(np.arange(200), np.arange(200, 400)))
    found = close_pairs(texts, left, right, np.full(len(left), 50))
    assert (found == (left + 200 == right)).all()
