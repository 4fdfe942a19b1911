from __future__ import annotations

import corpus_pipeline
from texts_data import SCHEMA, prose, rows_of

from cashcycle.llm import langid, lines, minhash
from cashcycle.llm.scratch import Scratch

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_meet_few_ids_by_a_shuffle(spark, monkeypatch):
    """Behind a broadcast, packing and unpacking would each hold a worker of the same task."""
    copied = prose(21, 80)
    docs = spark.createDataFrame(rows_of([(k, copied + f" {k}") for k in range(4)]), SCHEMA)
    plans, keep = [], Scratch.keep

    def kept(self, df, name):
        plans.append((name, plan_of(df)))
        return keep(self, df, name)

    monkeypatch.setattr(Scratch, "keep", kept)
    minhash.near_duplicates(docs).collect()
    removed = lines.remove_repeated_lines(docs)
    plans.append(("removed", plan_of(removed)))
    checked = [plan for name, plan in plans if name in ("sets", "words", "removed")]
    assert len(checked) == 3
    for plan in checked:
        assert "SortMergeJoin" in plan
    assert {r.doc_id for r in removed.filter("text = ''").collect()} == {1, 2, 3}


def test_stages_set_small_batches(spark):
    before = spark.conf.get(ARROW_ROWS)
    try:
        docs = spark.createDataFrame(rows_of([(1, prose(22, 80)), (2, prose(23, 80))]), SCHEMA)
        for name, stage in corpus_pipeline.STAGES[:3]:
            spark.conf.set(ARROW_ROWS, "10000")
            stage(spark, docs, "").collect()
            assert spark.conf.get(ARROW_ROWS) == str(corpus_pipeline.BATCH_ROWS), name
    finally:
        spark.conf.set(ARROW_ROWS, before)


def test_batches_of_one_task_share_an_identifier(spark):
    """Also with a row in a batch, the same documents stay."""
    texts = [(k, prose(300 + k, 30)) for k in range(20)] + [(90, None), (91, "12")]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA).coalesce(1)
    before = spark.conf.get(ARROW_ROWS)
    try:
        found = []
        for n in ("10000", "1"):
            spark.conf.set(ARROW_ROWS, n)
            found.append(sorted(r.doc_id for r in langid.keep_identified(docs, docs).collect()))
    finally:
        spark.conf.set(ARROW_ROWS, before)
    assert found[0] == found[1] and 90 not in found[0] and 91 not in found[0]
