"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all other training documents, whether
labelled clean or not labelled, are unlabelled. A linear classifier minimises the
non-negative risk ``p * E+[loss(g, 1)] + max(0, Eu[loss(g, 0)] - p * E+[loss(g, 0)])`` with
the class prior ``p``, the toxic share of the labelled training rows.

Features are the distinct words of a text and their first 4, 5 and 6 bytes (letters in lower
case, punctuation apart). Those that stand out among positives are kept: at most
``features``, by a z-score of their document shares. Training takes at most ``positives`` and
``unlabelled`` documents, those with the smallest hashed ids; scores cover whole texts of
all documents. Only text enters a score.

Null and empty texts get the score of a text without features. Without a positive or
an unlabelled training document every score is 0. Repeated label rows count as toxic if one
says so; labels that are null say nothing. Rows without ``doc_id`` are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcycle.llm.contamination import Seeds
from cashcycle.llm.lines import normalise
from cashcycle.llm.scratch import Scratch
from cashcycle.llm.tables import texts
from cashcycle.llm.textops import chunks, span_hashes, word_spans


@dataclass(frozen=True)
class ToxicityOptions:
    positives: int = 4000
    unlabelled: int = 12000
    features: int = 1024
    stems: tuple[int, ...] = (4, 5, 6)
    min_share: float = 0.005
    min_documents: int = 3
    min_lift: float = 3.0
    min_z: float = 4.0
    steps: int = 300
    rate: float = 0.05
    decay: float = 1e-4
    threshold: float = 0.7


def text_features(buf: np.ndarray, offsets: np.ndarray, stems: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and documents of all words and stems, with repeats."""
    folded = normalise(buf)
    starts, ends, documents = word_spans(folded, offsets)
    hashes, owners = [span_hashes(folded, starts, ends)], [documents]
    for stem in stems:
        long = ends - starts > stem
        hashes.append(span_hashes(folded, starts[long], starts[long] + stem) ^ np.uint64(stem << 32))
        owners.append(documents[long])
    return np.concatenate(hashes), np.concatenate(owners)


def _found(seeds: Seeds, buf: np.ndarray, offsets: np.ndarray, stems: tuple[int, ...]):
    """Distinct (document, feature number) pairs of the kept features."""
    hashes, documents = text_features(buf, offsets, stems)
    at, which = seeds.find(hashes)
    pairs = np.unique(documents[at] * max(1, len(seeds.hashes)) + which)
    return np.divmod(pairs, max(1, len(seeds.hashes)))


def _feature_counts(sample: DataFrame, stems: tuple[int, ...]) -> DataFrame:
    """(feature, pos, unl): in how many sampled documents of each kind a feature stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buf, offsets in chunks(batch):
                positive = rows.column("positive").to_numpy(zero_copy_only=False).astype(bool)
                hashes, documents = text_features(buf, offsets, stems)
                order = np.lexsort((documents, hashes))
                hashes, documents = hashes[order], documents[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (documents[1:] != documents[:-1])
                hashes, documents = hashes[new], documents[new]
                features, at = np.unique(hashes, return_index=True)
                toxic = positive[documents].astype(np.int64)
                pos = np.add.reduceat(toxic, at) if len(at) else toxic
                unl = np.add.reduceat(1 - toxic, at) if len(at) else toxic
                yield pa.RecordBatch.from_arrays(
                    [pa.array(features.view(np.int64)), pa.array(pos), pa.array(unl)],
                    ["feature", "pos", "unl"],
                )

    counts = sample.mapInArrow(run, "feature long, pos long, unl long").groupBy("feature")
    return counts.agg(F.sum("pos").alias("pos"), F.sum("unl").alias("unl"))


def nn_pu(x: np.ndarray, positive: np.ndarray, prior: float, options: ToxicityOptions) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier, by Adam on the non-negative risk."""
    n = x.shape[1]
    theta = np.zeros(n + 1)
    theta[n] = np.log(prior / (1 - prior))
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    of_p, of_u = 1 / positive.sum(), 1 / (~positive).sum()
    for step in range(1, options.steps + 1):
        g = x @ theta[:n].astype(np.float32) + theta[n]
        p = 1 / (1 + np.exp(-g))
        negative_loss = np.logaddexp(0, g)
        # derivatives of the logistic losses by g: p - 1 for class 1, p for class 0
        to_one = np.where(positive, prior * of_p * (p - 1), 0.0)
        to_zero = np.where(positive, -prior * of_p * p, of_u * p)
        surplus = of_u * negative_loss[~positive].sum() - prior * of_p * negative_loss[positive].sum()
        slope = to_one + to_zero if surplus >= 0 else -to_zero
        gradient = np.append(slope.astype(np.float32) @ x, slope.sum())
        gradient[:n] += options.decay * theta[:n]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= options.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:n], float(theta[n])


@dataclass
class ToxicityModel:
    seeds: Seeds
    weights: np.ndarray
    bias: float
    stems: tuple[int, ...]
    trained: bool = True

    def score(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        documents, which = _found(self.seeds, buf, offsets, self.stems)
        g = np.full(len(offsets) - 1, self.bias)
        np.add.at(g, documents, self.weights[which])
        return 1 / (1 + np.exp(-g)) if self.trained else np.zeros(len(g))


def train(docs: DataFrame, labels: DataFrame, options: ToxicityOptions | None = None) -> ToxicityModel:
    """A model of the training documents ``docs`` and their labels (doc_id, toxic)."""
    options = options or ToxicityOptions()
    own = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).dropna()
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    untrained = ToxicityModel(Seeds(np.empty(0, np.uint64)), np.empty(0), 0.0, options.stems, False)
    ids = texts(docs).select("doc_id").distinct()
    known = ids.join(own, "doc_id", "left").withColumn("positive", F.coalesce(F.col("toxic") == 1, F.lit(False)))
    share = known.agg(F.avg(F.when(F.col("toxic").isNotNull(), F.col("positive").cast("int")))).first()[0]
    if not share:
        return untrained
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.filter("positive").orderBy(*order).limit(options.positives)
    chosen = chosen.union(known.filter("NOT positive").orderBy(*order).limit(options.unlabelled))
    scratch = Scratch(docs.sparkSession)
    chosen = scratch.keep(chosen.select("doc_id", "positive"), "chosen")  # a bounded sample
    sample = scratch.keep(texts(docs).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]), "sample")
    n = {row.positive: row["count"] for row in chosen.groupBy("positive").count().collect()}
    if len(n) < 2:
        return untrained
    counts = _feature_counts(sample, options.stems)
    p, u = F.col("pos") / n[True], F.col("unl") / n[False]
    pooled = (F.col("pos") + F.col("unl")) / (n[True] + n[False])
    z = (p - u) / F.sqrt(pooled * (1 - pooled) * (1 / n[True] + 1 / n[False]) + 1e-12)
    least = max(options.min_documents, options.min_share * n[True])
    counts = counts.withColumn("z", z).filter((F.col("pos") >= least) & (p >= options.min_lift * u) & (F.col("z") >= options.min_z))
    kept = counts.orderBy(F.desc("z"), "feature").limit(options.features).select("feature").collect()
    seeds = Seeds(np.array([r.feature for r in kept], np.int64).view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buf, offsets in chunks(batch):
                documents, which = _found(seeds, buf, offsets, options.stems)
                at = np.searchsorted(documents, np.arange(len(offsets)))
                own = [which[lo:hi].astype(np.int32) for lo, hi in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("positive"), pa.array(own, pa.list_(pa.int32()))],
                    ["doc_id", "positive", "features"],
                )

    rows = sample.mapInArrow(run, "doc_id long, positive boolean, features array<int>")
    rows = rows.toPandas().sort_values("doc_id")  # the bounded sample's kept features
    scratch.drop("sample", "chosen")
    x = np.zeros((len(rows), len(seeds.hashes)), np.float32)
    for k, own_features in enumerate(rows["features"]):
        x[k, own_features] = 1
    weights, bias = nn_pu(x, rows["positive"].to_numpy(bool), min(max(share, 1e-6), 1 - 1e-6), options)
    return ToxicityModel(seeds, weights, bias, options.stems)


def score(docs: DataFrame, model: ToxicityModel, threshold: float = ToxicityOptions.threshold) -> DataFrame:
    """(doc_id, score, predicted) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buf, offsets in chunks(batch):
                scores = shared.value.score(buf, offsets)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                    ["doc_id", "score", "predicted"],
                )

    return texts(docs).mapInArrow(run, "doc_id long, score double, predicted int")
