"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cashcycle.llm import scoring, toxicity
from cashcycle.llm.contamination import find_leaks
from cashcycle.llm.embeddings import linked_vectors
from cashcycle.llm.langid import identify
from cashcycle.llm.lines import remove_repeated_lines
from cashcycle.llm.minhash import NearDuplicateOptions, near_duplicates
from cashcycle.llm.mixing import mix
from cashcycle.llm.packing import PackOptions, pack
from cashcycle.llm.periodic import find_runs, run_digest, with_periodic_tails
from cashcycle.llm.repeats import remove_repeats
from cashcycle.llm.search import search
from cashcycle.llm.secrets import find_secrets, secret_digest
from cashcycle.llm.tables import fold_of, read


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    options = scoring.ScoringOptions(public_tokenizers.path("word_bpe_49k.json"))
    scored = scoring.score(docs, docs.filter(fold_of("doc_id", 7) != 2), options)
    held_out = (fold_of("doc_id", 7) == 2).alias("held_out")
    columns = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return scored.select("doc_id", held_out, *columns)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), NearDuplicateOptions(shingle=2))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs.filter(fold_of("doc_id", 3) != 1), read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(find_secrets(read(spark, sf_dir, "documents")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = identify(docs, docs.filter(fold_of("doc_id", 4) != 2))
    held_out = (fold_of("doc_id", 4) == 2).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "margin", "rejected")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_chars", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack(read(spark, sf_dir, "documents"), PackOptions(path))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(read(spark, sf_dir, "embeddings"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(find_runs(with_periodic_tails(read(spark, sf_dir, "documents"))))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        op1_lm_scoring,
        op2_minhash,
        op3_decontamination,
        op4_repeats,
        op5_toxicity,
        op6_secrets,
        op7_language_id,
        op8_line_dedup,
        op9_packing,
        op10_embedding_dedup,
        op11_lexical_search,
        op12_source_mix,
        op13_periodic_runs,
        pipeline,
    ]
    return {f.__name__: f for f in named}
