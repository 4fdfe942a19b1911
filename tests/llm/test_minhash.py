from __future__ import annotations

import pytest
from texts_data import SCHEMA, awkward, rows_of, shingles, smallest_reachable

from cashcycle.llm.linking import components
from cashcycle.llm.minhash import NearDuplicateOptions, keep_representatives, near_duplicates
from cashcycle.llm.scratch import Scratch


def brute(rows, size):
    sets = {r[0]: shingles(r[1], size) for r in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[:k]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return {i: len(s) for i, s in sets.items()}, smallest_reachable(ids, links)


@pytest.mark.parametrize("size", [2, 5])
def test_against_brute_force(docs, size):
    sizes, label = brute(awkward(), size)
    found = near_duplicates(docs, NearDuplicateOptions(shingle=size)).collect()
    assert len(found) == len(awkward())
    for row in found:
        assert (row.n_shingles, row.component_id) == (sizes[row.doc_id], label[row.doc_id])
        assert row.kept == (row.doc_id == row.component_id)


def test_representatives_keep_their_columns(docs):
    kept = keep_representatives(docs.withColumnRenamed("source", "component_id"))
    _, label = brute(awkward(), 5)
    assert kept.columns == ["doc_id", "text", "lang", "component_id", "n_chars"]
    assert {r.doc_id for r in kept.collect()} == set(label.values())


def test_empty_table(empty):
    assert near_duplicates(empty).count() == 0
    assert keep_representatives(empty).count() == 0


def test_components_of_chains(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(200, 100), (100, 150), (300, 300), (200, 150)]
    found = components(Scratch(spark), spark.createDataFrame(chain, "a long, b long"))
    label = {r.id: r.component for r in found.collect()}
    assert label == {k: 0 for k in range(61)} | {100: 100, 150: 100, 200: 100}


def test_group_without_a_centre(spark):
    """Neighbours in a chain of edits are alike, its ends are not: one component."""
    text = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(30):
        rows.append((k, " ".join(text)))
        for j in range(6):
            text[(k * 6 + j) * 2 % 400] = f"x{k}-{j}"
    _, label = brute(rows_of(rows), 2)
    found = near_duplicates(spark.createDataFrame(rows_of(rows), SCHEMA), NearDuplicateOptions(shingle=2))
    assert {r.doc_id: r.component_id for r in found.collect()} == label
