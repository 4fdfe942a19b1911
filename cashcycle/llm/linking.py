"""Groups of linked items: candidates by shared keys, checked links, components.

``components`` contracts links to stars in a logarithmic number of joins.
``linked_groups`` finds components of all items that share a key and pass a check,
without a row for each pair of a large group. It first checks each item against one item
it shares a key with, then items against a few delegates of large components that they share
a key with, and at last what is still apart: items against the whole of a large
component, and items of small ones with each other. There the items of a key or a component
are put in blocks, and a row holds two blocks, which a task compares by array operations;
only keys of few items give a row for each pair. Nothing is capped: pairs that share a
key and are never checked are in one component already.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashcycle.llm.scratch import Scratch, arrow_rows


def _is_stars(edges: DataFrame) -> bool:
    """Each a has one b, and no b is an a."""
    sides = edges.select(F.col("a").alias("id"), F.lit(1).alias("below")).union(
        edges.select(F.col("b").alias("id"), F.lit(0).alias("below"))
    )
    seen = sides.groupBy("id").agg(F.sum("below").alias("below"), F.min("below").alias("least"))
    return seen.filter("below > 1 OR (below = 1 AND least = 0)").isEmpty()


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b): the smallest id reachable.

    Self-links and repeated links do no harm; without links the result is empty.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = scratch.keep(edges.filter("a <> b").distinct(), "edges0")
    turn = 0
    while not _is_stars(edges):
        turn += 1
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = least.select("a", F.col("m").alias("b"))
        edges = scratch.keep(small.union(stars).distinct(), f"edges{turn}")
        scratch.drop(f"edges{turn - 1}")
    members = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return members.union(roots)


Close = Callable[[Column, Column], Column]
# Takes the members of two blocks and a matrix of the pairs asked for; returns that of those that
# can be linked, hardly more than are.
Compare = Callable[[pa.StructArray, pa.StructArray, np.ndarray], np.ndarray]

SMALL = 32  # components of no more items are compared item by item
FEW = 16  # items of a key that give a row for each pair
_ROWS = 4  # pairs of blocks in a batch


def _any(left: Column, right: Column) -> Column:
    return F.lit(True)


def _sized(keys: DataFrame, found: DataFrame) -> DataFrame:
    """The items whose key still has several components, with component and size."""
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    known = found.join(sizes, "component").select("id", "component", "size")
    known = keys.join(known, "id", "left").select(
        "key",
        "id",
        "bits",
        F.coalesce("component", "id").alias("component"),
        F.coalesce("size", F.lit(1)).alias("size"),
    )
    mixed = known.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return known.join(mixed.filter("lo < hi").select("key"), "key")


def _probes(apart: DataFrame) -> DataFrame:
    """(id, bits, component): items and large components, not their own, that share a key."""
    groups = apart.filter(F.col("size") > SMALL)
    groups = groups.select("key", F.col("component").alias("c"), F.col("size").alias("n")).distinct()
    other = F.expr("component <> c AND (size < n OR (size = n AND component > c))")
    return apart.join(groups, "key").filter(other).select("id", "bits", F.col("c").alias("component")).distinct()


def _blocks(items: DataFrame, table: DataFrame, size: int) -> DataFrame:
    """(group, block, members): the items (group, id, own, keys, bits) of each group, with what
    ``table`` has of them, in blocks of about ``size``, numbered from 0."""
    n = items.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / size).cast("long").alias("blocks"))
    placed = items.join(n, "group").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    member = F.struct("id", "own", "keys", "bits", "item")
    return placed.join(table, "id").groupBy("group", "block").agg(F.collect_list(member).alias("members"))


def _met_before(left: pa.StructArray, right: pa.StructArray, key: int) -> np.ndarray:
    """Which pairs have a smaller key than this one in common."""
    sides = []
    for side in (left, right):
        keys = side.field("keys")
        owner = np.repeat(np.arange(len(side)), np.diff(keys.offsets.to_numpy()))
        values = keys.flatten().to_numpy()
        sides.append((owner[values < key], values[values < key]))
    common = np.intersect1d(sides[0][1], sides[1][1])
    marks = []
    for (owner, values), side in zip(sides, (left, right), strict=True):
        mark = np.zeros((len(side), len(common)), np.float32)
        there = np.isin(values, common)
        mark[owner[there], np.searchsorted(common, values[there])] = 1
        marks.append(mark)
    return marks[0] @ marks[1].T > 0


def _linked_in_blocks(rows: DataFrame, compare: Compare) -> DataFrame:
    """Pairs (a, b) to check between the blocks ``x`` and ``y`` of rows (group, x, y, same): of items of
    different components, at the first key that they have in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("group", "x", "y", "same")]
            for group, x, y, same in zip(*columns, strict=True):
                x, y = x.values, y.values
                (ids, own), (ids_y, own_y) = ([v.field(c).to_numpy() for c in ("id", "own")] for v in (x, y))
                asked = own[:, None] != own_y
                if same.as_py():
                    asked &= ids[:, None] < ids_y
                asked &= ~_met_before(x, y, group.as_py())
                if asked.any():
                    at_x, at_y = np.nonzero(compare(x, y, asked))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at_x]), pa.array(ids_y[at_y])], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def _with_bits(found: DataFrame, members: DataFrame) -> DataFrame:
    """(component, member, other): the members of each component with their bits."""
    bits = members.select("id", F.col("bits").alias("other")).distinct()
    return found.join(bits, "id").select("component", F.col("id").alias("member"), "other")


def _delegates(whole: DataFrame, n: int) -> DataFrame:
    """``n`` members of each component, by hash."""
    order = Window.partitionBy("component").orderBy(F.xxhash64("member"), "member")
    return whole.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= n).drop("at")


def linked_groups(
    scratch: Scratch,
    keys: DataFrame,
    prepare: Callable[[DataFrame], None],
    check: Callable[[DataFrame], DataFrame],
    payload: Callable[[], DataFrame],
    compare: Compare,
    close: Close | None = None,
    brief: Callable[[], tuple[DataFrame, Close]] | None = None,
    delegates: int = 8,
    block: int = 64,
) -> DataFrame:
    """(id, component) of items that share a key and pass ``check``, transitively.

    ``keys`` is (key, id), distinct. ``prepare`` gets the ids that share a key at all, once.
    ``check`` takes pairs (a, b), a and b different, and returns those that are linked.
    ``compare`` leaves out what is not linked of the members of two blocks of about ``block`` items,
    structs with the id, the bits and what ``payload``, a table (id, item), has of them. With ``close``,
    keys have a third column ``bits``, and only pairs whose bits are close can be linked: others
    are dropped as soon as both sides meet. Where bits are too long to go with every key,
    ``brief`` returns (id, brief) and what is close by it, for the pairs of single items.
    Items without links are left out.
    """
    if close is None:
        close, keys = _any, keys.withColumn("bits", F.lit(0))
    pair = F.struct("id", "bits")
    shared = keys.groupBy("key").agg(
        F.min(pair).alias("lead"), F.max(pair).alias("last"), F.count(F.lit(1)).alias("n")
    )
    # two members that are not close: nothing to find under this key
    some = (F.col("n") > 2) | close(F.col("lead.bits"), F.col("last.bits"))
    shared = shared.filter((F.col("lead.id") < F.col("last.id")) & some).select("key", "lead")
    members = scratch.keep(keys.join(shared, "key"), "members")
    prepare(members.select("id").distinct())
    stars = members.filter((F.col("id") != F.col("lead.id")) & close(F.col("lead.bits"), F.col("bits")))
    stars = stars.groupBy("id").agg(F.min("lead.id").alias("lead"))
    links = scratch.keep(check(stars.select(F.col("lead").alias("a"), F.col("id").alias("b"))), "links_stars")
    members = members.select("key", "id", "bits")

    def against(probes: DataFrame, whole: DataFrame) -> DataFrame:
        pairs = probes.alias("p").join(
            whole.alias("w"),
            (F.col("p.component") == F.col("w.component")) & close(F.col("p.bits"), F.col("w.other")),
        )
        return check(pairs.select(F.col("member").alias("a"), F.col("id").alias("b")))

    found = scratch.keep(components(scratch, links), "groups1")
    apart = scratch.keep(_sized(members, found), "apart1")
    more = against(_probes(apart), _delegates(_with_bits(found, members), delegates))
    more = scratch.keep(more, "links_delegates")
    if not more.isEmpty():
        links = links.union(more)
        found = scratch.keep(components(scratch, links), "groups2")
        apart = scratch.keep(_sized(members, found), "apart2")
    table = payload()
    none = F.array().cast("array<long>")
    probes = _probes(apart).select(F.col("component").alias("group"), "id", "bits")
    probes = scratch.keep(probes.withColumn("own", F.lit(-1).cast("long")).withColumn("keys", none), "probes")
    whole = _with_bits(found, members).join(probes.select(F.col("group").alias("component")).distinct(), "component")
    whole = whole.select(F.col("component").alias("group"), F.col("member").alias("id"), F.col("other").alias("bits"))
    whole = scratch.keep(whole.withColumn("own", F.lit(-2).cast("long")).withColumn("keys", none), "whole")
    loose = apart.filter(F.col("size") <= SMALL).select("key", "id", "bits", "component")
    counts = loose.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi")
    )
    loose = loose.join(counts.filter("lo < hi").select("key", "n"), "key")
    kept = loose.groupBy("id").agg(F.collect_set("key").alias("keys"))
    loose = scratch.keep(loose.join(kept, "id"), "loose")

    # few bytes, much work: adaptive execution would leave it to a few tasks
    parts = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))

    def dealt(blocks: DataFrame) -> DataFrame:
        return blocks.repartition(parts, "group", "block")

    # pairs of blocks, each with the blocks of its group up to its own, or with all of the component
    large = loose.filter(F.col("n") > FEW).select(F.col("key").alias("group"), "id", F.col("component").alias("own"), "keys", "bits")
    blocks = scratch.keep(_blocks(large, table, block), "blocks_keys")
    later = blocks.select("group", F.col("block").alias("of"), F.col("members").alias("y"))
    later = later.withColumn("block", F.explode(F.expr("sequence(0L, of)")))
    rows = dealt(blocks.withColumnRenamed("members", "x")).join(dealt(later), ["group", "block"])
    rows = rows.select("group", "x", "y", (F.col("block") == F.col("of")).alias("same"))
    bodies = scratch.keep(_blocks(whole, table, block), "blocks_whole")
    askers = _blocks(probes, table, block).select("group", F.col("members").alias("y"))
    askers = askers.join(bodies.groupBy("group").agg(F.max("block").alias("last")), "group")
    askers = askers.select("group", "y", F.explode(F.expr("sequence(0L, last)")).alias("block"))
    more = dealt(bodies.withColumnRenamed("members", "x")).join(dealt(askers), ["group", "block"])
    rows = rows.union(more.select("group", "x", "y", F.lit(False)))
    with arrow_rows(scratch.spark, _ROWS):
        in_blocks = scratch.keep(_linked_in_blocks(rows, compare), "pairs_blocks")

    few = loose.filter(F.col("n") <= FEW).select("key", "id", "bits", "component", "keys")
    near = close(F.col("x.bits"), F.col("y.bits"))
    if brief is not None:
        short, by_brief = brief()
        few = few.join(short, "id")
        near = near & by_brief(F.col("x.brief"), F.col("y.brief"))
    x, y = few.alias("x"), few.alias("y")
    first = F.expr(
        "x.key = y.key AND x.id < y.id AND x.component <> y.component"
        " AND array_min(array_intersect(x.keys, y.keys)) = x.key"
    )
    pairs = x.join(y, first & near)
    pairs = pairs.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    last = scratch.keep(check(in_blocks.union(pairs)), "links_last")
    scratch.drop("members", "apart1", "apart2", "probes", "whole", "loose", "blocks_keys", "blocks_whole", "pairs_blocks")
    if last.isEmpty():
        return found
    return scratch.keep(components(scratch, links.union(last)), "groups3")
