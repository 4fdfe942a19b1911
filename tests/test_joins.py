"""Lookup joins and brand clean-up, small and large, against plain Python."""

from __future__ import annotations

import random

import pytest

from cashcycle.operators.brands import brand_spellings, canonical_brands
from cashcycle.operators.joins import join_lookup

NAMES = ["xiao mi", "xiaomi", "XiaoMi", "a b c", "abc", "ab c", "solo", "two words", None, ""]


def expected_brand(brand, names):
    """Rename a blank-free spelling to the last of its spaced forms."""
    if brand is None or " " in brand:
        return brand
    spaced = [n for n in names if n and " " in n and n.replace(" ", "") == brand]
    return max(spaced, default=brand)


@pytest.fixture(params=["10MB", "-1"])
def threshold(spark, request):
    """Lookups that are broadcast, and lookups that are not."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_canonical_brands(spark, threshold):
    random.seed(3)
    rows = [(n, random.choice(NAMES)) for n in range(300)]
    rows += [(n, "xiaomi") for n in range(300, 500)]
    source = spark.createDataFrame(rows, "id int, brand string").repartition(3)
    names = {brand for _, brand in rows}
    got = canonical_brands(source).collect()
    assert sorted(got) == [(i, expected_brand(b, names)) for i, b in rows]


def test_only_existing_blank_free_spellings_are_mapped(spark):
    source = spark.createDataFrame(
        [("two words",), ("ab c",), ("a bc",), ("solo",)], "brand string"
    )
    spellings = {r.brand: r.spaced for r in brand_spellings(source).collect()}
    assert spellings == {"abc": "ab c"}
    kept = sorted(r.brand for r in canonical_brands(source).collect())
    assert kept == ["a bc", "ab c", "solo", "two words"]


def test_join_lookup_keeps_every_row(spark, threshold):
    rows = spark.range(4000).selectExpr("id", "IF(id % 3 = 0, 0, id % 50) AS k")
    lookup = spark.range(40).selectExpr("id AS k", "id * 10 AS v")
    joined = join_lookup(rows, lookup, ["k"])
    assert ("BroadcastHashJoin" in plan_of(joined)) == (threshold != "-1")
    got = {r.id: (r.k, r.v) for r in joined.collect()}
    assert len(got) == joined.count() == 4000
    for i, (k, v) in got.items():
        assert k == (0 if i % 3 == 0 else i % 50)
        assert v == (k * 10 if k < 40 else None)


def test_large_lookup_is_merged_and_hot_keys_are_split(spark):
    rows = spark.range(0, 400_000, 1, 16).selectExpr(
        "IF(id % 3 = 0, 0, id % 5000) AS k", "CAST(id AS STRING) AS text"
    )
    lookup = spark.range(5000).selectExpr("id AS k", "id AS v")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = join_lookup(rows, lookup, ["k"])
        assert len(joined.collect()) == 400_000
        plan = plan_of(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "SortMergeJoin(skew=true)" in plan
    assert "BroadcastHashJoin" not in plan
