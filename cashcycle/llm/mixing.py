"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

The mix takes ``share`` times the words of all sources, divided by the sources' weights. A source
gives at most ``most_copies`` times its own words; what it cannot give is shared again among the
others by weight, until no target is above (``targets``). A source of size ``S`` and target ``T``
gives ``T / S`` copies of each of its words:

* certain copies: every document is taken whole ``floor(T / S)`` times;
* sampled copies: for the rest ``f`` of ``T / S`` the documents are ranked by random odds divided
  by inclusion odds, ``(U / (1 - U)) / (f / (1 - f))``, and the first ones are taken once more
  until their words make up the remaining target. ``U`` comes from the md5 of the id, so
  reruns, repeated tasks and lost executors draw the same. A column with relative ``odds`` of the
  documents multiplies the inclusion odds; without it the odds differ between sources only.

The fixed size is one of words, as documents differ widely in length. The cut is found without
sorting a source: the words of each of 2**20 slices of the rank scale are summed, and all slices
that fit as a whole are taken. From the first that does not fit, and the slices behind it until
``fill`` documents are reached, each document that still fits is taken in rank order, and the
shortest of the others if the total comes nearer to the target with it.

Tables are one row a document without texts, and one a source; a hot source is summed by all
tasks before anything is shuffled, and no step holds a source's documents. Sources of the lookup
are joined by Spark, which broadcasts them only if the written table is small and else splits a
hot key. Targets are found by rounds of one sum over the sources.

A null text has size 0, and a null source is a source, the last. Rows without ``doc_id`` are left
out; other columns are ignored. Repeated rows are documents each; rows of one id and source are
sampled together, as they have the same rank. A source without words has target 0. Documents
whose odds are null, NaN or not positive, and empty ones, are not sampled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashcycle.llm.scratch import Scratch

_SLICE_BITS, _RANK_BITS = 20, 52


@dataclass(frozen=True)
class MixOptions:
    weights: tuple[float, ...] = (3, 1, 2)  # of the sources by code point, repeating
    share: float = 1.5
    most_copies: int = 2
    fill: int = 1000
    odds: str | None = None  # a column of positive numbers


def sized(docs: DataFrame, odds: str | None = None) -> DataFrame:
    """(doc_id, source, size, odds) of rows that have an id; size in words."""
    words = F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(
        F.col("doc_id").cast("long"),
        F.col("source").cast("string"),
        F.coalesce(words, F.lit(0)).cast("long").alias("size"),
        (F.col(odds).cast("double") if odds else F.lit(1.0)).alias("odds"),
    ).filter("doc_id IS NOT NULL")


def _positions(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """The sources with their place by code point from 0, null last."""
    order = [F.col("source").isNull(), F.col("source")]
    parts = sources.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ordered = sources.repartitionByRange(int(parts), *order).sortWithinPartitions(*order)
    ordered = scratch.keep(ordered.withColumn("at", F.monotonically_increasing_id()), "mix-order")
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    counts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    found = ordered.withColumn("part", part).join(offsets, "part")
    return found.select("source", "source_size", (F.col("offset") + row).alias("place"))


def targets(documents: DataFrame, options: MixOptions, scratch: Scratch) -> DataFrame:
    """(source, source_size, target) of all sources."""
    sizes = documents.groupBy("source").agg(F.sum("size").alias("source_size"))
    own = F.element_at(
        F.array(*[F.lit(float(w)) for w in options.weights]),
        (F.col("place") % len(options.weights) + 1).cast("int"),
    )
    cap = (F.col("source_size") * options.most_copies).cast("double")
    table = _positions(sizes, scratch).withColumn("weight", own).withColumn("cap", cap)
    table, full = scratch.keep(table, "mix-sources"), F.lit(False)
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * options.share
    weighed, capped = -1.0, 0
    while True:
        free, taken, n = table.agg(
            F.sum(F.when(~full, F.col("weight"))), F.sum(F.when(full, F.col("cap"))), F.count_if(full)
        ).first()
        if n == capped and weighed >= 0 or not free:
            break
        capped, weighed = n, (total - (taken or 0.0)) / free
        full = F.col("weight") * weighed > F.col("cap")
    given = F.when(full, F.col("cap")).otherwise(F.col("weight") * max(weighed, 0.0))
    return table.select("source", "source_size", (given if free else F.col("cap")).alias("target"))


def mix(docs: DataFrame, options: MixOptions = MixOptions()) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken): how often each document is
    taken, and the words that makes."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    documents = scratch.keep(sized(docs, options.odds), "mix-documents")
    plan = targets(documents, options, scratch)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("copies", whole.cast("long"))
    rest = F.greatest(F.col("target") - F.col("copies") * F.col("source_size"), F.lit(0.0))
    plan = scratch.keep(plan.withColumn("rest", rest).withColumnRenamed("source", "name"), "mix-plan")

    ranked = _ranked(documents, plan)
    slices = ranked.filter("rank IS NOT NULL").groupBy("source", "slice", "rest")
    slices = slices.agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    order = Window.partitionBy("source").orderBy("slice")
    slices = slices.withColumn("until", F.sum("words").over(order)).withColumn("cut", F.col("until") > F.col("rest"))
    slices = slices.withColumn("beyond", F.sum(F.when(F.col("cut"), F.col("n")).otherwise(0)).over(order))
    cuts = slices.filter(F.col("cut") & (F.col("beyond") - F.col("n") < options.fill)).groupBy("source")
    room = F.max(F.col("rest") - F.col("until") + F.col("words")).alias("room")
    cuts = cuts.agg(F.min("slice").alias("first"), F.max("slice").alias("final"), room)
    plan = scratch.keep(_with(plan, cuts), "mix-cuts")

    near = _ranked(documents, plan).filter(F.col("slice").between(F.col("first"), F.col("final")))
    units = near.groupBy("source", "rank", "room").agg(F.sum("size").alias("words"))
    listed = units.groupBy("source", "room").agg(F.array_sort(F.collect_list(F.struct("rank", "words"))).alias("units"))
    plan = scratch.keep(_with(plan, listed.select("source", _fitting().alias("chosen"))), "mix-chosen")

    once = (
        F.when(F.col("rank").isNull(), False)
        .when(F.col("first").isNull() | (F.col("slice") < F.col("first")), True)
        .when(F.col("slice") <= F.col("final"), F.array_contains("chosen", F.col("rank")))
        .otherwise(False)
    )
    result = _ranked(documents, plan).withColumn("copies", F.col("copies") + F.when(once, 1).otherwise(0))
    return result.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def _with(plan: DataFrame, more: DataFrame) -> DataFrame:
    """Two tables with a row for each source."""
    return plan.join(more, F.col("name").eqNullSafe(F.col("source")), "left").drop("source")


def _ranked(documents: DataFrame, plan: DataFrame) -> DataFrame:
    """The documents with their source's plan; ``rank`` where the sample can take them, a whole
    number from 0 to 2**52: their odds ratio ``r`` as ``r / (1 + r)``; ``slice`` is its first bits."""
    digits = F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << _RANK_BITS)
    ratio = (u / (1 - u)) / (F.col("rest") / (F.col("source_size") - F.col("rest")) * F.col("odds"))
    rank = F.floor(ratio / (1 + ratio) * float(1 << _RANK_BITS)).cast("long")
    sampled = (F.col("rest") > 0) & (F.col("size") > 0) & (F.col("odds") > 0) & ~F.isnan("odds")
    joined = documents.join(plan, F.col("source").eqNullSafe(F.col("name")), "left").drop("name")
    joined = joined.withColumn("rank", F.when(sampled, rank))
    return joined.withColumn("slice", F.shiftright("rank", _RANK_BITS - _SLICE_BITS))


def _fitting() -> Column:
    """The ranks of ``units`` that are taken: in order, each that still fits into ``room``, and the
    shortest other one if the total comes nearer with it."""
    none = F.struct(F.lit(None).cast("long").alias("words"), F.lit(None).cast("long").alias("rank"))
    start = F.struct(
        F.col("room").alias("room"), F.array().cast("array<long>").alias("ranks"), none.alias("shortest")
    )

    def step(state: Column, unit: Column) -> Column:
        fits = unit["words"] <= state["room"]
        other = F.struct(unit["words"].alias("words"), unit["rank"].alias("rank"))
        nearer = state["shortest"]["words"].isNull() | (unit["words"] < state["shortest"]["words"])
        return F.struct(
            F.when(fits, state["room"] - unit["words"]).otherwise(state["room"]).alias("room"),
            F.when(fits, F.array_append(state["ranks"], unit["rank"])).otherwise(state["ranks"]).alias("ranks"),
            F.when(~fits & nearer, other).otherwise(state["shortest"]).alias("shortest"),
        )

    def close(state: Column) -> Column:
        last = state["shortest"]
        return F.when(last["words"] < 2 * state["room"], F.array_append(state["ranks"], last["rank"])).otherwise(
            state["ranks"]
        )

    return F.aggregate("units", start, step, close)
