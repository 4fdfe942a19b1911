"""Language-model scores of documents, with a unigram base to compare.

The model (``attention``) has the token counts of all training documents, and its weights learn
from every window of every one, at any size of the corpus. These are dealt to trainers, one for ``trainer_bytes`` of text up to
``max_trainers``, which then take more each; in each of ``rounds`` rounds every trainer goes through
its windows from the same weights (more than once where that is fewer than ``min_steps`` steps, up to
``max_passes`` times), and the weights are averaged by Spark. Every whole text is then scored in
overlapping windows, each token once.

The base counts words (runs of bytes other than white space, A-Z as a-z) and one end per
document over all training documents. Words are compared by 64-bit hash. A text's base score
sums ``log10((c + 1) / (N + V + 1))``. Counts of the ``frequent`` most frequent words are
sent to the tasks; the rest of a text's words meet their counts in a join, so no table that
grows with the corpus is broadcast.

Null texts count as empty: one token, the end. Rows with one ``doc_id`` are scored each by
its own text. Rows without ``doc_id`` are left out; other columns are ignored. Without
training documents all counts are 0 and the model is as it starts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcycle.llm.attention import AttentionOptions, Model, Vocabulary, inputs_and_targets, window_tokens
from cashcycle.llm.contamination import Seeds
from cashcycle.llm.scratch import Scratch, arrow_rows
from cashcycle.llm.tables import texts
from cashcycle.llm.textops import bounds, chunks, give_back, span_hashes, word_spans
from cashcycle.llm.tokens import encoder, forget_encoders


@dataclass(frozen=True)
class ScoringOptions:
    tokenizer: str
    end_id: int = 49407
    model: AttentionOptions = field(default_factory=AttentionOptions)
    trainer_bytes: int = 32_000_000
    max_trainers: int = 1 << 12
    rounds: int = 1
    min_steps: int = 200
    max_passes: int = 6
    frequent: int = 1 << 16


_MERGE_AT = 2_000_000
_SLICE = 1 << 14  # weights averaged together
_AVERAGED = 64  # trainers averaged in one step
_SEGMENT = 1 << 18  # windows a trainer holds at once
_TEXTS = 512  # in a batch
_PIECES = 4  # rows of windows in a batch or written together, of half a MB each


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c): how often each word hash occurs, combined in each task before the shuffle."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        words, which = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
        n = np.bincount(which, weights=np.concatenate([c for _, c in parts]), minlength=len(words))
        return words, n.astype(np.int64)

    def batch_of(words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for _, buf, offsets in chunks(batch):
                starts, ends, _ = word_spans(buf, offsets)
                parts.append(np.unique(span_hashes(buf, starts, ends, fold=True), return_counts=True))
            if sum(len(w) for w, _ in parts) > _MERGE_AT:
                parts = [merged(parts)]
                if len(parts[0][0]) > _MERGE_AT // 2:
                    yield batch_of(*parts.pop())
        if parts:
            yield batch_of(*merged(parts))
        parts.clear()
        give_back()

    return texts(train).select("text").mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _encoded(batch: pa.RecordBatch, options: ScoringOptions):
    words = encoder(options.tokenizer)
    for rows, buf, offsets in chunks(batch):
        yield rows, buf, offsets, *words.encode(buf, offsets)


def _token_kind(options: ScoringOptions) -> np.dtype:
    """The shortest integers that hold all token ids and the two marks of ``window_tokens``."""
    return np.dtype("<u2" if encoder(options.tokenizer).tokenizer.get_vocab_size() < 0xFFFE else "<u4")


def _packed_windows(token: np.ndarray, kind: np.dtype) -> bytes:
    return token.astype(kind).tobytes()  # -1 and -2 become the two largest numbers


def _unpacked(token: np.ndarray) -> np.ndarray:
    least = np.iinfo(token.dtype).max - 1
    return np.where(token >= least, token.astype(np.int64) - (least + 2), token).astype(np.int32)


def _unpacked_windows(data: bytes, kind: np.dtype, width: int) -> np.ndarray:
    return _unpacked(np.frombuffer(data, kind).reshape(-1, width))


def _lessons(train: DataFrame, options: ScoringOptions) -> DataFrame:
    """(size, windows, id, n): all windows of all texts, as bytes, with the bytes of the texts
    they are from; and how often each token id occurs in all texts, by task."""
    kind = _token_kind(options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(encoder(options.tokenizer).tokenizer.get_vocab_size(), np.int64)

        def row(size: int, taken: bytes, some: np.ndarray) -> pa.RecordBatch:
            lists = [pa.array([x], pa.list_(pa.int64())) for x in (some, counts[some])]
            return pa.RecordBatch.from_arrays(
                [pa.array([size], pa.int64()), pa.array([taken], pa.binary()), *lists], ["size", "windows", "id", "n"]
            )

        for batch in batches:
            for _, buf, offsets, ids, at in _encoded(batch, options):
                counts += np.bincount(ids, minlength=len(counts))
                counts[options.end_id] += len(offsets) - 1
                parts = window_tokens(ids, at, options.end_id, options.model)
                # a very long text may need several rows
                for k, (token, _) in enumerate(parts):
                    yield row(0 if k else len(buf), _packed_windows(token, kind), np.empty(0, np.int64))
        yield row(0, b"", np.flatnonzero(counts))
        give_back()

    return train.mapInArrow(run, "size long, windows binary, id array<long>, n array<long>")


def _token_counts(lessons: DataFrame, options: ScoringOptions) -> np.ndarray:
    """How often each token id occurs in training documents: one row per id at most."""
    total = np.zeros(encoder(options.tokenizer).tokenizer.get_vocab_size(), np.int64)
    each = lessons.select(F.inline(F.arrays_zip("id", "n")))
    for row in each.groupBy("id").agg(F.sum("n").alias("n")).collect():
        total[row.id] = row.n
    return total


def _mean(trained: DataFrame, trainers: int) -> DataFrame:
    """(part, weights): the mean over trainers, in two steps where there are many."""
    kinds = "part int, bucket int, n long, weights binary"

    def total(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("weights")  # the same sum in any order of arrival
        sums = np.stack([np.frombuffer(w, np.float64) for w in group["weights"]]).sum(0)
        return group[:1].assign(n=group["n"].sum(), weights=[sums.tobytes()])

    if trainers > _AVERAGED:
        trained = trained.groupBy("part", "bucket").applyInPandas(total, kinds)
    return trained.groupBy("part").applyInPandas(total, kinds)


def _one_round(dealt: DataFrame, model: Model, turn: int, trainers: int, options: ScoringOptions) -> Model:
    """The mean of what all trainers make of ``model``."""
    shared = dealt.sparkSession.sparkContext.broadcast(model)
    buckets = int(np.ceil(np.sqrt(trainers)))
    width, kind = options.model.context + options.model.scored, _token_kind(options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value.with_flat(shared.value.flat())
        trainer = TaskContext.get().partitionId()
        pieces, size, segments = [], 0, 0

        def learn() -> None:
            token = np.concatenate(pieces)
            pieces.clear()  # not held beside what is learned from

            def lesson(take: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                return inputs_and_targets(_unpacked(token[take]), own.vocabulary, options.model)

            once = -(-len(token) // options.model.batch)
            steps = min(max(options.min_steps, once), options.max_passes * once)
            own.learn(len(token), lesson, steps, seed=1000 * turn + segments)

        forget_encoders()
        give_back()
        for batch in batches:
            for taken in batch.column("windows"):
                pieces.append(np.frombuffer(taken.as_py(), kind).reshape(-1, width))  # as they travel
                size += len(pieces[-1])
                if size >= _SEGMENT:
                    learn()
                    size, segments = 0, segments + 1
        if size:
            learn()
            segments += 1
        if segments:
            flat = own.flat()
            parts = [flat[k : k + _SLICE].astype(float).tobytes() for k in range(0, len(flat), _SLICE)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(parts)), pa.int32()),
                    pa.array([trainer % buckets] * len(parts), pa.int32()),
                    pa.array([1] * len(parts), pa.int64()),
                    pa.array(parts, pa.binary()),
                ],
                ["part", "bucket", "n", "weights"],
            )

    trained = dealt.mapInArrow(run, "part int, bucket int, n long, weights binary")
    with arrow_rows(dealt.sparkSession, _PIECES):
        rows = sorted((r.part, r.n, r.weights) for r in _mean(trained, trainers).collect())  # one model
    if not rows:
        return model
    flat = np.concatenate([np.frombuffer(w, float) / n for _, n, w in rows])
    return model.with_flat(flat.astype(np.float32))


def fit(train: DataFrame, options: ScoringOptions) -> Model:
    """A model of training documents."""
    scratch = Scratch(train.sparkSession)
    rows = texts(train).filter("text IS NOT NULL")
    with arrow_rows(scratch.spark, _TEXTS):
        lessons = scratch.keep(_lessons(rows, options), "lessons", at_once=_PIECES)
    model = Model.start(Vocabulary.fit(_token_counts(lessons, options), options.model), options.model)
    total = lessons.agg(F.sum("size")).first()[0] or 0
    trainers = int(np.clip(np.ceil(total / options.trainer_bytes), 1, options.max_trainers))
    pieces = lessons.filter("octet_length(windows) > 0").select("windows", F.xxhash64("windows").alias("drawn"))
    dealt = pieces.repartition(trainers, "drawn").sortWithinPartitions("drawn").select("windows")
    for turn in range(options.rounds):
        model = _one_round(dealt, model, turn, trainers, options)
    scratch.drop("lessons")
    return model


def score(docs: DataFrame, train: DataFrame, options: ScoringOptions) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    with arrow_rows(spark, _TEXTS):
        counts = scratch.keep(word_counts(train), "counts")
    words, distinct = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    ends = texts(train).count()
    n, v = (words or 0) + ends, distinct + (ends > 0)
    top = counts.orderBy(F.desc("c"), "word").limit(options.frequent).collect()
    hashes = np.array([r.word for r in top], np.int64).view(np.uint64)
    seeds = Seeds(hashes)
    known = np.array([r.c for r in top], np.int64)[np.argsort(hashes)]
    shared = spark.sparkContext.broadcast((fit(train, options), seeds, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, frequent, times = shared.value
        gains = np.log10(times + 1.0)
        for batch in batches:
            for rows, buf, offsets, ids, at in _encoded(batch, options):
                size = len(offsets) - 1
                scores = np.zeros(size)
                for token, owner in window_tokens(ids, at, options.end_id, options.model):
                    found = model.log10(*inputs_and_targets(token, model.vocabulary, options.model))
                    scores += np.bincount(owner, weights=found.sum(1), minlength=size)
                starts, ends_, documents = word_spans(buf, offsets)
                found = span_hashes(buf, starts, ends_, fold=True)
                hit, which = frequent.find(found)
                sums = np.bincount(documents[hit], weights=gains[which], minlength=size).astype(float)
                n_hit = np.bincount(documents[hit], minlength=size)
                rare = np.ones(len(found), bool)
                rare[hit] = False
                rest, edges = found[rare], bounds(documents[rare], size)
                lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(rest.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        rows.column("digest"),
                        pa.array(np.bincount(documents, minlength=size) + 1),
                        pa.array(n_hit),
                        pa.array(sums),
                        pa.array(scores),
                        lists,
                    ],
                    ["doc_id", "digest", "n_tokens", "n_hit", "gain", "score", "rare"],
                )
        give_back()

    rows = texts(docs).withColumn("digest", F.xxhash64(F.coalesce("text", F.lit(""))))
    kinds = "doc_id long, digest long, n_tokens long, n_hit long, gain double, score double, rare array<long>"
    with arrow_rows(spark, _TEXTS):
        scored = scratch.keep(rows.mapInArrow(run, kinds), "scored")
    rare = scored.filter("size(rare) > 0").dropDuplicates(["doc_id", "digest"])
    rare = rare.select("doc_id", "digest", F.explode("rare").alias("word"))
    rare = rare.groupBy("word", "doc_id", "digest").agg(F.count(F.lit(1)).alias("times")).join(counts, "word")
    rare = rare.groupBy("doc_id", "digest").agg(
        F.sum("times").alias("n_rare"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("rare_gain")
    )
    each = float(np.log10(n + v + 1))
    end_gain = float(np.log10(ends + 1))
    gain = F.col("gain") + F.coalesce("rare_gain", F.lit(0.0)) + end_gain
    return scored.drop("rare").join(rare, ["doc_id", "digest"], "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_hit") + F.coalesce("n_rare", F.lit(0)) + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (gain - F.col("n_tokens") * each).alias("base_score"),
        "score",
    )
