"""Edit distances walk only what differs; letter counts as counted line by line."""

from __future__ import annotations

import random

import numpy as np
from test_lines import edit_distance
from texts_data import prose

from cashcycle.llm import edits
from cashcycle.llm.lines import letter_counts, line_offsets, normalise


def test_middles_keep_the_distance():
    draw = random.Random(9)
    for _ in range(2000):
        x, y = (np.array([draw.randrange(3) for _ in range(draw.randrange(9))], np.uint8) for _ in range(2))
        a, b = edits._middles(x, y)
        assert edit_distance(a.tolist(), b.tolist()) == edit_distance(x.tolist(), y.tolist())
        assert not (len(a) and len(b)) or (a[0] != b[0] and a[-1] != b[-1])


def test_only_what_differs_is_walked(monkeypatch):
    walked, within = [], edits._within

    def seen(left, right, most):
        walked.extend(len(t) for t in (*left, *right))
        return within(left, right, most)

    monkeypatch.setattr(edits, "_within", seen)
    texts, changed = [prose(k, 200) for k in range(20)], []
    for text in texts:
        words = text.split()
        words[90:94] = ["z" * len(w) for w in words[90:94]]
        changed.append(" ".join(words))
    found = edits.close_pairs([*texts, *changed], np.arange(20), np.arange(20, 40), np.full(20, 9))
    assert found.tolist() == [edit_distance(a, b) <= 9 for a, b in zip(texts, changed, strict=True)]
    assert 0 < max(walked) < 50


def test_letter_counts_by_line():
    texts = ["b\n\na c!\nÉé 12\n", "", "\n", "zz zz\nx", "漢字 a"]
    parts = [t.encode() for t in texts]
    buf = np.frombuffer(b"".join(parts), np.uint8)
    edges, _ = line_offsets(buf, np.cumsum([0, *map(len, parts)]))
    normal = normalise(buf)
    lines = [normal[a:b].tobytes().decode() for a, b in zip(edges[:-1], edges[1:], strict=True)]
    numbers = np.array([k for k, line in enumerate(lines) if line.strip()])
    sizes, bits = letter_counts(normal, edges, numbers)
    assert sizes.tolist() == [len("".join(lines[k].split())) for k in numbers]
    for own, k in zip(bits, numbers, strict=True):
        alone = np.frombuffer(lines[k].encode(), np.uint8)
        assert (letter_counts(alone, np.array([0, len(alone)]), np.array([0]))[1][0] == own).all()
