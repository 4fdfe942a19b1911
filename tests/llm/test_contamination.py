from __future__ import annotations

import numpy as np
from texts_data import SCHEMA, edited, prose, rows_of

from cashcycle.llm.contamination import Item, LeakOptions, align, find_leaks, most_common, without_leaks


def plain_score(text, item):
    best, row = 0, [0] * (len(text) + 1)
    for w in item:
        new = [0]
        for k, t in enumerate(text):
            new.append(max(0, row[k] + (2 if t == w else -1), row[k + 1] - 1, new[k] - 1))
        best, row = max(best, *new), new
    return best


def test_alignment_against_plain_version():
    draw = np.random.default_rng(3)
    for _ in range(60):
        text, item = draw.integers(0, 5, draw.integers(1, 30)), draw.integers(0, 5, draw.integers(1, 15))
        score, first, last = align(text, item)
        assert score == plain_score(text.tolist(), item.tolist())
        assert plain_score(text[first:last].tolist(), item.tolist()) == score


def corpus(spark):
    items = [(k, prose(700 + k, 30)) for k in range(5)] + [(5, "tiny pair"), (6, None), (7, ""), (8, prose(708, 40))]
    texts = [(k, prose(800 + k, 200)) for k in range(30)]
    texts += [(100, f"{prose(900, 50)} {items[0][1].upper()} {prose(901, 50)}")]
    texts += [(101, f"{prose(902, 500)} {edited(items[1][1], 5, 0.15)} {prose(903, 5)}")]
    texts += [(102, items[2][1])]
    texts += [(110 + k, f"{prose(910 + k, 20)} {items[8][1]} {prose(950 + k, 20)}") for k in range(40)]
    texts += [(200, None), (201, ""), (202, "a tiny pair here")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3), benchmark


LEAKS = {(100, 0), (101, 1), (102, 2), (202, 5)} | {(110 + k, 8) for k in range(40)}


def test_planted_passages(spark):
    docs, benchmark = corpus(spark)
    found = find_leaks(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == LEAKS
    by = {(r.doc_id, r.item_id): r for r in found}
    assert by[100, 0].similarity == 1 and (by[100, 0].first_word, by[100, 0].last_word) == (50, 80)
    assert 0.5 <= by[101, 1].similarity < 1


def test_slices_give_the_same(spark):
    docs, benchmark = corpus(spark)
    whole = {tuple(r) for r in find_leaks(docs, benchmark).collect()}
    sliced = find_leaks(docs, benchmark, LeakOptions(slice_chars=300))
    assert {tuple(r) for r in sliced.collect()} == whole


def test_filter_keeps_clean_documents(spark, empty):
    docs, benchmark = corpus(spark)
    kept = without_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in docs.select("doc_id").collect()} - {r.doc_id for r in kept.select("doc_id").collect()}
    assert gone == {d for d, _ in LEAKS}
    assert find_leaks(empty, benchmark).count() == 0
    assert find_leaks(docs, benchmark.filter("false")).count() == 0


def test_edited_copy_beside_exact_copies(spark):
    """4 of 30 words changed, 11 of 27 n-grams left; the copies hold all of them."""
    for copies in (1, 40):
        item = prose(720, 30).split()
        other = list(item)
        for k in (4, 9, 14, 19):
            other[k] = f"changed{k}"
        rows = [(k, f"{prose(3000 + k, 20)} {' '.join(item)}") for k in range(copies)]
        rows += [(500, f"{prose(4000, 50)} {' '.join(other)} {prose(4001, 50)}")]
        benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
        found = {r.doc_id: r for r in find_leaks(spark.createDataFrame(rows_of(rows), SCHEMA), benchmark).collect()}
        assert set(found) == {*range(copies), 500}
        assert found[500].score == 48 and found[500].first_word == 50


def test_bound_never_drops_an_alignment():
    draw = np.random.default_rng(4)
    for _ in range(200):
        text, own = draw.integers(0, 6, draw.integers(1, 30)), draw.integers(0, 6, draw.integers(1, 15))
        item = Item(0, own.astype(np.uint64), own)
        assert align(text, own)[0] <= 2 * most_common(text.astype(np.uint64), item)
