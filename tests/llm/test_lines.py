from __future__ import annotations

import random

import numpy as np
from texts_data import SCHEMA, prose, rows_of

from cashcycle.llm import lines
from cashcycle.llm.lines import letter_counts, line_offsets, normalise, remove_repeated_lines


def test_lines(spark):
    long, other = prose(11, 60), prose(12, 40)
    near = long.split()
    near[30] = "zz"
    texts = [
        (1, f"{long}\nshort line\n{other}"),
        (2, f"Intro number one of five words\n{long.upper()}\nshort line"),
        (3, " ".join(near)),
        (4, f"{other}!\n{other}\n"),
        (5, None),
        (6, ""),
        (7, "\n\n"),
        (8, f"{other} and quite a lot of other words that follow here to make it another line"),
    ]
    found = {r.doc_id: r for r in remove_repeated_lines(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()}
    assert found[1].text == texts[0][1]
    assert found[2].text == "Intro number one of five words\nshort line"
    assert found[2].n_chars == len(found[2].text)
    assert found[4].text == ""
    assert [found[k].text for k in (5, 6, 7, 8)] == [t for _, t in texts[4:]]


def test_one_changed_word_is_found_for_most_long_lines(spark):
    texts = []
    for k in range(60):
        words = prose(100 + k, 120, 300).split()
        texts.append((k, " ".join(words)))
        words[50] = "zzzz"
        texts.append((1000 + k, " ".join(words)))
    found = remove_repeated_lines(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()
    gone = {r.doc_id for r in found if r.text == ""}
    assert all(k >= 1000 for k in gone) and len(gone) > 40


def test_hot_line_and_clashing_columns(spark):
    line = prose(13, 20)
    rows = [(k, f"{line}\n{prose(500 + k, 30)}") for k in range(300)]
    docs = spark.createDataFrame(rows_of(rows), SCHEMA).withColumnRenamed("source", "line")
    found = remove_repeated_lines(docs)
    assert found.columns == docs.columns
    assert sum(line in r.text for r in found.collect()) == 1


def test_empty_and_awkward(empty, docs):
    assert remove_repeated_lines(empty).count() == 0
    assert remove_repeated_lines(docs).count() == docs.count()


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_recall_against_brute_force_on_ordinary_lines(spark):
    """One word changed in lines of 10 to 50 words; what the edit distance takes is found."""
    draw, texts, want = random.Random(9), [], set()
    for k in range(150):
        words = prose(7000 + k, (10, 12, 20, 30, 50)[k % 5], 3000).split()
        texts.append((k, " ".join(words)))
        words[draw.randrange(len(words))] = prose(9000 + k, 1)
        texts.append((1000 + k, " ".join(words)))
        longer = max(len(texts[-1][1]), len(texts[-2][1]))
        if edit_distance(texts[-1][1], texts[-2][1]) <= int(longer * 0.1 + 1e-9):
            want.add(1000 + k)
    found = remove_repeated_lines(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()
    gone = {r.doc_id for r in found if r.text == ""}
    assert gone <= want and len(want) > 120
    assert len(gone) >= 0.97 * len(want)


def test_rows_of_numbers_are_no_copies(spark):
    rows = [
        (1, "2019 01 02 03 04 balance due 1500 dollars\n12 34 56 78 90 11 22\nthe same line in both texts"),
        (2, "2024 11 12 13 14 balance due 9732 dollars\n98 76 54 32 10 99 88\nthe same line in both texts"),
    ]
    found = {r.doc_id: r.text for r in remove_repeated_lines(spark.createDataFrame(rows_of(rows), SCHEMA)).collect()}
    assert found[1] == rows[0][1]
    assert found[2].startswith("2024 11 12 13 14 balance due 9732 dollars\n98 76 54 32 10 99 88")
    assert "the same" not in found[2]


def test_letter_counts_bound_the_edit_distance():
    """Half the bits in which two lines differ is never more than their edit distance."""
    draw = random.Random(4)
    lines = []
    for k in range(40):
        text = prose(300 + k, 12, 50) + " é漢字 07"[: draw.randrange(9)]
        lines.append(text)
        letters = list(text)
        for _ in range(draw.randrange(1, 9)):
            letters[draw.randrange(len(letters))] = draw.choice("abz 7漢é")
        lines.append(" ".join("".join(letters).split()))
    buf = np.frombuffer("\n".join(lines).encode(), np.uint8)
    edges, _ = line_offsets(buf, np.array([0, len(buf)]))
    _, bits = letter_counts(normalise(buf), edges, np.arange(len(lines)))
    near = 0
    for a in range(len(lines)):
        for b in range(a + 1, min(a + 6, len(lines))):
            differ = sum(int(x).bit_count() for x in bits[a] ^ bits[b])
            distance = edit_distance(lines[a], lines[b])
            assert differ <= 2 * distance
            near += differ > 10
    assert near > 100


def test_copies_of_short_and_unspaced_lines(spark):
    chinese = "".join(chr(0x4E00 + 37 * k % 5000) for k in range(160))
    rows = [(k, f"four words of boilerplate\n{chinese}\nthe end\nown {prose(40 + k, 20)}") for k in range(3)]
    found = {r.doc_id: r.text for r in remove_repeated_lines(spark.createDataFrame(rows_of(rows), SCHEMA)).collect()}
    assert found[0] == rows[0][1]
    for k in (1, 2):
        assert found[k] == f"the end\nown {prose(40 + k, 20)}"


def test_columns_named_like_the_helpers(spark):
    line = prose(13, 20)
    docs = spark.createDataFrame(rows_of([(1, line), (2, line)]), SCHEMA).withColumnRenamed("source", "Removed")
    docs = docs.withColumnRenamed("lang", "id_of_removed")
    found = remove_repeated_lines(docs)
    assert found.columns == docs.columns
    assert {r.doc_id: r.text for r in found.collect()} == {1: line, 2: ""}


def test_keys_of_one_line_are_told_packed(spark, monkeypatch):
    """The same keys as by counting rows, from a few rows of packed keys, also with many groups."""
    monkeypatch.setattr(lines, "_HELD", 50)
    options = lines.LineOptions(bands=4)
    draw = np.random.default_rng(5)
    # bands of 32 bits from the whole range, one in three of a few values
    wide = draw.integers(0, 1 << 32, (400, 4), dtype=np.uint64)
    few = draw.choice(np.array([0, 1, 7, 1 << 31, (1 << 32) - 1], np.uint64), (400, 4))
    bands = np.where(draw.random((400, 4)) < 0.33, few, wide)
    want = {}
    for code, own in enumerate(bands):
        for k, low in enumerate(own):
            want.setdefault((k << 32) + int(low), []).append(code - 200)
    want = sorted((key, i) for key, ids in want.items() if len(ids) > 1 for i in ids)
    pairs = (bands[:, 0::2] | bands[:, 1::2] << np.uint64(32)).view(np.int64).tolist()
    rows = [(code - 200, *own) for code, own in enumerate(pairs)]
    items = spark.createDataFrame(rows, "code long, bands0 long, bands1 long").repartition(3)
    for each in (1000, 30):
        found = lines.shared_keys(items, options, keys_each=each)
        assert sorted((r.key, r.id) for r in found.collect()) == want
        assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    assert lines.shared_keys(items.filter("false"), options).count() == 0


def test_first_places_of_any_ids_without_sorting_all_lines(spark, monkeypatch):
    line = prose(31, 20)
    ids = [5, 0, 2**63 - 1, -7, -(2**63), 12]
    texts = [(k, f"{prose(800 + n, 12)}\n{line}\n{line}") for n, k in enumerate(ids)]
    plans, keep = {}, lines.Scratch.keep

    def kept(self, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return keep(self, df, name)

    monkeypatch.setattr(lines.Scratch, "keep", kept)
    for left in (ids, [k for k in ids if k >= 0], [2**63 - 1]):
        rows = [(k, t) for k, t in texts if k in left]
        found = remove_repeated_lines(spark.createDataFrame(rows_of(rows), SCHEMA).repartition(3))
        found = {r.doc_id: r.text for r in found.collect()}
        first = min(left)
        assert all(t.count(line) == (k == first) for k, t in found.items())
        assert all(t.startswith(dict(texts)[k].split("\n")[0]) for k, t in found.items())
    assert "SortAggregate" not in plans["items"]
