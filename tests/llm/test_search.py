from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from texts_data import FOLD, SCHEMA, awkward, prose, rows_of

from cashcycle.llm.search import SearchOptions, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = [
    (1, prose(1, 20) + " " + prose(9, 20, 30)),
    (2, "ONE Two; one-one é"),
    (3, prose(2, 400)),
    (4, None),
    (5, " .,; "),
    (6, "nowhere-to-be-found 99"),
    (7, prose(3, 5)),
    (None, "one"),
    (8, "one"),
    (8, "one"),
    (9, "zzz"),
    (9, "two"),
]


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def plain(rows, items, top=10):
    docs = [(i, Counter(terms(t))) for i, t in rows if i is not None]
    n_docs, total = sum(bool(c) for _, c in docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    smallest = {}
    for i, text in items:
        if i is not None and text is not None:
            smallest[i] = min(smallest.get(i, text), text)
    out = []
    for item, text in smallest.items():
        scored = []
        for i, c in docs:
            m = 100 - 75 + 75 * c.total() * n_docs // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text)
                if c[t]
            )
            scored += [(-score, i)] if score > 0 else []
        out += [(item, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scored)[:top])]
    return sorted(out)


@pytest.mark.parametrize(
    "options", [SearchOptions(), SearchOptions(top=3, cells=20), SearchOptions(block_postings=25)], ids=str
)
def test_against_plain_version(spark, docs, options):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = sorted(map(tuple, search(docs, items, options).collect()))
    assert found == plain([r[:2] for r in awkward()], ITEMS, options.top)
    assert {r[0] for r in found} >= {1, 2, 3, 7, 8, 9} and not {r[0] for r in found} & {4, 5}


def test_ties_repeated_rows_and_long_texts(spark):
    rows = [(k, "same words here") for k in range(50, 0, -1)] + [(7, "same words here")] * 3
    rows += [(k, f"filler {k} text") for k in range(100, 200)] + [(300, prose(5, 60000)), (None, "same"), (-1, None)]
    items = [(1, "same words"), (2, prose(5, 10))]
    found = search(
        spark.createDataFrame(rows_of(rows), SCHEMA).repartition(5), spark.createDataFrame(items, "item_id long, text string")
    )
    found = sorted(map(tuple, found.collect()))
    assert found == plain(rows, items)
    assert [r[2] for r in found if r[0] == 1] == [1, 2, 3, 4, 5, 6, 7, 7, 7, 7]


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 6, 7)], "doc_id int, text string, rank int, score int, item_id int")
    items = spark.createDataFrame([(1, "a", 9, 8)], "item_id int, text string, doc_id int, term int")
    assert [tuple(r)[:3] for r in search(docs, items).collect()] == [(1, 1, 1)]


def test_empty_tables(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = search(docs, items).schema.simpleString()
    for found in (search(empty, items), search(docs, items.limit(0)), search(empty, items.limit(0))):
        assert found.collect() == [] and found.schema.simpleString() == want
