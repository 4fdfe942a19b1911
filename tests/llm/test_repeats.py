from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from texts_data import SCHEMA, awkward, prose, rows_of

from cashcycle.llm.repeats import RepeatOptions, remove_repeats


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        gone, reach = bytearray(len(d)), 0
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                for q in range(max(p, reach), p + length):
                    gone[q] = 1
                reach = p + length
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        spans = sum(gone[q] and (q == 0 or not gone[q - 1]) for q in range(len(d)))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def check(spark, texts, options):
    docs = spark.createDataFrame(rows_of(enumerate(texts)), SCHEMA).repartition(3)
    found = {r.doc_id: r for r in remove_repeats(docs, options, with_text=True).collect()}
    for k, want in enumerate(brute(texts, options.length)):
        row = found[k]
        assert (row.n_bytes, row.n_removed, row.n_spans, row.kept_sha256, bytes(row.kept)) == want, k


@pytest.mark.parametrize("length,anchor", [(200, 100), (20, 10), (8, 3)])
def test_against_brute_force(spark, length, anchor):
    passage = prose(21, 60)
    texts = [f"{prose(30 + k, 40)} {passage} {prose(60 + k, 40)}" for k in range(6)]
    texts += [None, "", "a", "Wher. " * 100, "ab" * 150, "é" * 230, "To " * 70 + "of " * 90]
    texts += [passage[:199], passage[3:203], "x" + passage[3:203] + "y", passage, passage]
    texts += [prose(90, 80), prose(90, 80)[:300] + "!" + prose(90, 80)[301:]]
    check(spark, texts, RepeatOptions(length, anchor))


def test_awkward_rows(spark, docs, empty):
    found = remove_repeats(docs).collect()
    assert len(found) == len(awkward())
    copies = [r for r in found if r.doc_id == 400]
    assert len(copies) == 2 and all(r.n_removed == r.n_bytes for r in copies)
    assert remove_repeats(empty).count() == 0
