from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F
from texts_data import smallest_reachable

from cashcycle.llm.linking import FEW, linked_groups
from cashcycle.llm.scratch import Scratch


def test_large_keys_meet_in_blocks_not_in_pairs(spark):
    """Numbers on a line, near ones linked: the rows of pairs grow with the items of a key, not with
    their square, and no link under a common key is lost."""
    draw = np.random.default_rng(8)
    places = {int(k): int(x) for k, x in enumerate(draw.permutation(4000)[:500])}
    under = {k: {1, 10 + k % 7, 100 + k % 90} if k % 5 else {10 + k % 7, 200 + k % 45} for k in places}
    near = 3
    links = [
        (a, b) for a in places for b in places
        if a < b and under[a] & under[b] and abs(places[a] - places[b]) <= near
    ]
    label = smallest_reachable(places, links)
    table = spark.createDataFrame(list(places.items()), "id long, item long")
    keys = spark.createDataFrame([(key, k) for k, own in under.items() for key in own], "key long, id long")
    checked = []

    def check(pairs):
        checked.append(pairs.count())
        x, y = (table.select(F.col("id").alias(c), F.col("item").alias(f"at_{c}")) for c in "ab")
        return pairs.join(x, "a").join(y, "b").filter(F.abs(F.col("at_a") - F.col("at_b")) <= near).select("a", "b")

    def compare(left, right, asked):
        x, y = (side.field("item").to_numpy() for side in (left, right))
        return asked & (np.abs(x[:, None] - y) <= near)

    found = linked_groups(Scratch(spark), keys, lambda ids: None, check, lambda: table, compare, block=40)
    grouped = {r.id: r.component for r in found.collect()}
    assert {k: grouped.get(k, k) for k in places} == label and len(set(label.values())) < len(places)
    assert max(checked) <= FEW * keys.count()
    assert max(checked) < 20_000 < 400 * 399 // 2
