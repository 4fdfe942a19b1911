"""A training corpus from raw documents: five stages, each written and read again.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns the next
stage's documents, the last one the packed pieces. ``run`` applies them to ``documents``.

1. language ID: documents whose language is not clear go;
2. line dedup: one occurrence of each group of near-equal lines stays;
3. near dedup: one document of each group of near duplicates stays;
4. decontamination: documents that hold a test item go;
5. packing: the rest as sequences of at most 4096 tokens.

Each stage sets its session to batches of ``BATCH_ROWS`` texts for Python tasks, which its
result keeps to when it is written.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cashcycle.llm.contamination import without_leaks
from cashcycle.llm.langid import keep_identified
from cashcycle.llm.lines import remove_repeated_lines
from cashcycle.llm.minhash import keep_representatives
from cashcycle.llm.packing import PackOptions, pack
from cashcycle.llm.scratch import Scratch
from cashcycle.llm.tables import read

TOKENIZER = "word_bpe_49k.json"
BATCH_ROWS = 512


def _in_batches(stage):
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run


@_in_batches
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs, docs)


@_in_batches
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeated_lines(docs)


@_in_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_representatives(docs)


@_in_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, read(spark, sf_dir, "benchmark"))


@_in_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, PackOptions(public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Compression, alignment and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the whole corpus."""
    docs, scratch = read(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
