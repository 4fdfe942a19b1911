from __future__ import annotations

import random
from collections import defaultdict

import pytest
from texts_data import awkward

from cashcycle.llm.mixing import MixOptions, mix

SCHEMA = "doc_id long, text string, source string"


def corpus(sizes: dict, seed: int = 1, n: int = 300):
    draw, rows = random.Random(seed), []
    for source, share in sizes.items():
        for _ in range(int(n * share)):
            rows.append((len(rows), "w " * min(400, int(draw.expovariate(1 / 40))), source))
    return rows


def plain_targets(sizes: dict, options: MixOptions):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weights = {s: options.weights[k % len(options.weights)] for k, s in enumerate(order)}
    full, total = set(), options.share * sum(sizes.values())
    while True:
        left = total - sum(options.most_copies * sizes[s] for s in full)
        free = sum(weights[s] for s in order if s not in full)
        level = left / free if free else 0
        more = {s for s in order if s not in full and level * weights[s] > options.most_copies * sizes[s]}
        if not more:
            return {s: options.most_copies * sizes[s] if s in full else level * weights[s] for s in order}
        full |= more


@pytest.mark.parametrize(
    "sizes,options",
    [
        ({"a": 3, "b": 1, "c": 1, "d": 2, None: 1}, MixOptions()),
        ({"Ä": 1, "z": 1, "a": 1, "": 1}, MixOptions(weights=(1,), share=0.3)),
        ({"a": 1, "b": 5, "c": 0.2}, MixOptions(weights=(5, 1), share=2.2, most_copies=4, fill=20)),
        ({"a": 1}, MixOptions()),
    ],
    ids=str,
)
def test_targets_and_taken_words(spark, sizes, options):
    rows = corpus(sizes)
    found = mix(spark.createDataFrame(rows, SCHEMA).repartition(7), options).collect()
    assert sorted(r.doc_id for r in found) == [r[0] for r in rows]
    own, taken, longest, target = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for r in found:
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= options.most_copies
        own[r.source] += r["size"]
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r["size"])
        target[r.source] = r.target
    assert {s: round(t, 6) for s, t in target.items()} == {s: round(t, 6) for s, t in plain_targets(own, options).items()}
    for source, words in taken.items():
        assert abs(words - target[source]) <= 5, source
        whole = int(target[source] // own[source])
        assert {r.copies for r in found if r.source == source} <= {whole, whole + 1}


def test_reruns_agree_in_any_partitioning(spark):
    rows = corpus({"a": 2, "b": 1, "c": 1})
    runs = [sorted(map(tuple, mix(spark.createDataFrame(rows, SCHEMA).repartition(n)).collect())) for n in (1, 9)]
    assert runs[0] == runs[1]


def test_odds_decide_who_is_sampled(spark):
    rows = [(k, "one two three", "s", (0.1, 1.0, 10.0, None, 0.0, float("nan"))[k % 6]) for k in range(6000)]
    found = mix(spark.createDataFrame(rows, SCHEMA + ", q double"), MixOptions(share=0.25, odds="q")).collect()
    share = [sum(r.copies for r in found if r.doc_id % 6 == k) / 1000 for k in range(6)]
    assert share[0] < share[1] < share[2] and share[3:] == [0, 0, 0]
    assert abs(sum(r.taken for r in found) - 4500) <= 3


def test_awkward_documents(spark, docs):
    found = mix(docs).collect()
    assert sorted(r.doc_id for r in found) == sorted(r[0] for r in awkward())
    size = {r.doc_id: (r["size"], r.copies) for r in found}
    assert size[200][0] == size[201][0] == size[202][0] == 0 and size[302][0] == 30000
    assert len({r.copies for r in found if r.doc_id == 400}) == 1


def test_sources_without_words_clashing_names_and_no_rows(spark, empty):
    rows = [(1, None, None, 1, 2), (2, " ", "a", 1, 2), (3, "x y", "b", 1, 2), (None, "z", "b", 1, 2)]
    found = mix(spark.createDataFrame(rows, SCHEMA + ", target int, copies int")).collect()
    assert sorted((r.doc_id, r.target, r.taken) for r in found) == [(1, 0.0, 0), (2, 0.0, 0), (3, 3.0, 2)]
    assert mix(empty).collect() == []


def test_no_python_on_the_way(spark, docs):
    plan = mix(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
