"""The registered queries run, and agree with SQL where there is any."""

from __future__ import annotations

import duckdb
import pytest
from compare import canonical

import corpus_pipeline
from cashcycle.llm.oracle import ORACLES
from cashcycle.llm.queries import registered


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    ours = registered()[name](spark, sf_dir).toPandas()
    assert canonical(ours) == canonical(connection.execute(ORACLES[name]).df())


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in registered() if n != "pipeline"] == [f"op{k}" for k in range(1, 14)]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    assert kept <= ids and len(kept) > 0.7 * len(ids)
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in packed} == kept
