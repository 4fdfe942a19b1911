"""Near-duplicate embeddings by product quantisation with coarse inverted lists.

Vectors are scaled to length 1. A coarse quantiser (k-means on a bounded sample: about
the square root of the number of vectors, ``max_lists`` at most, ``sample_per_list`` sampled
vectors each) puts each vector into the list of its nearest centroid; what is left to the
centroid is coded in subspaces of ``subspace`` components with 16 codewords each. Every vector is indexed
and is a query. It probes each list whose cell it could leave by a step of ``probe_slack`` times
the linking distance across the border: 1 would be provably all, and as a step's share across a
border is small in many dimensions, less is enough. A pair is found if either of its
vectors probes the other's list.

Within a list a query's distances to codes come from a table per subspace. A
vector's own quantisation error is stored, so the triangle inequality drops only what
cannot be linked; what is left is measured exactly, in double precision.

Identical vectors are one weighted item, whatever their number: it is compared once and counts
as many links as it has copies.

Lists and their queries are cut into blocks by hash, and each pair of blocks is one group:
no task holds a whole list, however many vectors are alike. Groups return counts and
spanning links, never all pairs. Only centroids, codewords and list sizes go through the
driver, bounded by ``max_lists``.

Null vectors, zero vectors and vectors with a null or non-finite component are linked with
nothing; vectors of different lengths are not compared. Rows with one ``vec_id`` are one
vector (the smallest of them, null first); rows without are left out. Labels and
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashcycle.llm.linking import components
from cashcycle.llm.scratch import Scratch


@dataclass(frozen=True)
class EmbeddingOptions:
    cosine: float = 0.95
    max_lists: int = 4096
    sample_per_list: int = 32
    subspace: int = 8
    codewords: int = 16
    probe_slack: float = 0.35
    list_block: int = 2048
    query_block: int = 2048
    rounds: int = 8

    @property
    def reach(self) -> float:
        """The distance of unit vectors at the linking cosine."""
        return float(np.sqrt(max(0.0, 2 - 2 * self.cosine)))


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, unit): vectors of length 1 as bytes of doubles; null if there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, units = [], []
            for value in batch.column("embedding"):
                v = np.array(value.values.to_numpy(zero_copy_only=False), float) if value.is_valid else np.empty(0)
                top = np.abs(v).max() if len(v) and np.isfinite(v).all() else 0.0
                if top > 0:
                    v = v / top
                    units.append((v / np.sqrt((v * v).sum())).tobytes())
                else:
                    units.append(None)
                dims.append(len(v))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(dims, pa.int32()), pa.array(units, pa.binary())],
                ["vec_id", "dim", "unit"],
            )

    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    rows = rows.filter("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return rows.mapInArrow(run, "vec_id long, dim int, unit binary")


def _square_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * (x @ c.T), 0)


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each vector, a block of distances at a time."""
    blocks = np.array_split(x, len(x) // 4096 + 1)
    return np.concatenate([_square_distances(b, centroids).argmin(1) for b in blocks])


def k_means(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Centroids; an empty one keeps its place. Deterministic for the order of ``x``."""
    centroids = np.unique(x, axis=0)
    centroids = centroids[np.random.default_rng(7).permutation(len(centroids))[:k]]
    for _ in range(rounds):
        nearest = _nearest(x, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        counts = np.bincount(nearest, minlength=len(centroids))
        some = counts > 0
        centroids[some] = sums[some] / counts[some, None]
    return centroids


@dataclass
class Index:
    centroids: np.ndarray
    parts: list[np.ndarray]  # columns of each subspace
    codebooks: list[np.ndarray]
    options: EmbeddingOptions
    between: np.ndarray | None = None  # of centroids, worked out once in each worker

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int, options: EmbeddingOptions) -> Index:
        centroids = k_means(sample, lists, options.rounds)
        rest = sample - centroids[_nearest(sample, centroids)]
        parts = np.array_split(np.arange(sample.shape[1]), -(-sample.shape[1] // options.subspace))
        books = [k_means(rest[:, p], options.codewords, options.rounds) for p in parts]
        return cls(centroids, parts, books, options)

    def probes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest list of each vector, and which lists it probes."""
        d = _square_distances(x, self.centroids)
        own = d.argmin(1)
        if self.between is None:
            self.between = np.sqrt(_square_distances(self.centroids, self.centroids))
        limit = 2 * self.options.probe_slack * self.options.reach * self.between[own]
        return own, d - d[np.arange(len(x)), own][:, None] <= limit

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and quantisation errors."""
        rest = x - self.centroids[own]
        codes = np.stack([_square_distances(rest[:, p], b).argmin(1) for p, b in zip(self.parts, self.codebooks, strict=True)], 1)
        lost = rest - np.concatenate([b[codes[:, k]] for k, b in enumerate(self.codebooks)], 1)
        return codes.astype(np.uint8), np.sqrt((lost * lost).sum(1))

    def table_distances(self, q: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of queries to coded vectors of a list, by table lookup."""
        rest = q - self.centroids[cell]
        total = np.zeros((len(q), len(codes)))
        for k, (p, book) in enumerate(zip(self.parts, self.codebooks, strict=True)):
            total += _square_distances(rest[:, p], book)[:, codes[:, k]]
        return np.sqrt(total)


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), float).reshape(-1, dim)


def _indexed(units: DataFrame, index, dim: int) -> DataFrame:
    """(vec_id, n_copies, unit, cell, codes, error, probed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_index = index.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                rows = batch.slice(lo, 1024)
                x = _matrix(rows.column("unit").to_pylist(), dim)
                own, probed = own_index.probes(x)
                codes, errors = own_index.encode(x, own)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("vec_id"),
                        rows.column("n_copies"),
                        rows.column("unit"),
                        pa.array(own.astype(np.int32)),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(errors),
                        pa.array([np.flatnonzero(p).astype(np.int32) for p in probed], pa.list_(pa.int32())),
                    ],
                    ["vec_id", "n_copies", "unit", "cell", "codes", "error", "probed"],
                )

    return units.mapInArrow(
        run, "vec_id long, n_copies long, unit binary, cell int, codes binary, error double, probed array<int>"
    )


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For n nodes and links a-b, the smallest node each is connected with."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _matcher(index, dim: int, options: EmbeddingOptions):
    def run(key, lists: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"vec_id": [], "n": [], "root": []}).astype("int64")
        if not len(lists) or not len(queries):
            return none
        own, cell = index.value, int(key[0])
        y = _matrix(lists["unit"], dim)
        codes = np.frombuffer(b"".join(lists["codes"]), np.uint8).reshape(len(lists), -1)
        errors = lists["error"].to_numpy(float)
        list_ids, query_ids = lists["vec_id"].to_numpy(np.int64), queries["vec_id"].to_numpy(np.int64)
        home = queries["home"].to_numpy(np.int64)
        probed = [set(map(int, p)) for p in lists["probed"]]
        q_at, v_at = [], []
        for lo in range(0, len(queries), 256):
            q = _matrix(queries["unit"].iloc[lo : lo + 256], dim)
            near = own.table_distances(q, cell, codes) <= options.reach + errors + 1e-9
            for k in np.flatnonzero(near.any(1)):
                maybe = np.flatnonzero(near[k])
                good = maybe[y[maybe] @ q[k] >= options.cosine]
                good = good[list_ids[good] != query_ids[lo + k]]
                v_at.append(good)
                q_at.append(np.full(len(good), lo + k))
        if not q_at or not sum(map(len, q_at)):
            return none
        q_at, v_at = np.concatenate(q_at), np.concatenate(v_at)
        ids = np.unique(np.concatenate([query_ids[q_at], list_ids[v_at]]))
        a, b = np.searchsorted(ids, query_ids[q_at]), np.searchsorted(ids, list_ids[v_at])
        here, there = queries["n_copies"].to_numpy(np.int64), lists["n_copies"].to_numpy(np.int64)
        counts = np.zeros(len(ids), np.int64)
        np.add.at(counts, a, there[v_at])
        # a vector that does not probe its query's list would not find it by itself
        back = np.array([home[q] not in probed[v] for q, v in zip(q_at.tolist(), v_at.tolist(), strict=True)], bool)
        np.add.at(counts, b[back], here[q_at[back]])
        return pd.DataFrame({"vec_id": ids, "n": counts, "root": ids[_spanning(a, b, len(ids))]})

    return run


def _links_of(scratch: Scratch, units: DataFrame, dim: int, options: EmbeddingOptions) -> DataFrame:
    """(vec_id, n, root): partial link counts and spanning links of different vectors of one length."""
    spark = units.sparkSession
    total = units.count()
    lists = int(min(options.max_lists, np.ceil(np.sqrt(total))))
    sample = units.orderBy(F.xxhash64("vec_id"), "vec_id").limit(lists * options.sample_per_list)
    fitted = Index.fit(_matrix([r.unit for r in sample.select("unit").collect()], dim), lists, options)
    index = spark.sparkContext.broadcast(fitted)
    indexed = scratch.keep(_indexed(units, index, dim), f"indexed{dim}")
    again = spark.read.schema(indexed.schema).parquet(scratch.paths[f"indexed{dim}"])
    queries = again.select("vec_id", "n_copies", "unit", F.col("cell").alias("home"), F.explode("probed").alias("cell"))
    sizes = indexed.groupBy("cell").agg(F.count(F.lit(1)).alias("n_list"))
    sizes = sizes.join(queries.groupBy("cell").agg(F.count(F.lit(1)).alias("n_query")), "cell")
    sizes = scratch.keep(
        sizes.select(
            "cell",
            F.ceil(F.col("n_list") / options.list_block).cast("int").alias("list_blocks"),
            F.ceil(F.col("n_query") / options.query_block).cast("int").alias("query_blocks"),
        ),
        f"lists{dim}",
    )
    bounded = F.broadcast(sizes)  # a row a list, max_lists at most
    block = F.xxhash64("vec_id")
    entries = indexed.join(bounded, "cell").select(
        "cell",
        F.pmod(block, "list_blocks").cast("int").alias("list_part"),
        F.explode(F.expr("sequence(0, query_blocks - 1)")).alias("query_part"),
        "vec_id",
        "n_copies",
        "unit",
        "codes",
        "error",
        "probed",
    )
    asked = queries.join(bounded, "cell").select(
        "cell",
        F.explode(F.expr("sequence(0, list_blocks - 1)")).alias("list_part"),
        F.pmod(block, "query_blocks").cast("int").alias("query_part"),
        "vec_id",
        "n_copies",
        "unit",
        "home",
    )
    group = ["cell", "list_part", "query_part"]
    both = entries.groupBy(*group).cogroup(asked.groupBy(*group))
    return both.applyInPandas(_matcher(index, dim, options), "vec_id long, n long, root long")


def linked_vectors(vectors: DataFrame, options: EmbeddingOptions | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    options = options or EmbeddingOptions()
    scratch = Scratch(vectors.sparkSession)
    units = unit_vectors(vectors).withColumn("digest", F.sha2("unit", 256))
    units = scratch.keep(units, "units")
    classes = units.filter("unit IS NOT NULL").groupBy("dim", "digest")
    classes = classes.agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("n_copies"), F.min("unit").alias("unit"))
    classes = scratch.keep(classes, "classes")
    found = None
    for (dim,) in classes.select("dim").distinct().orderBy("dim").collect():  # the vectors' lengths
        part = classes.filter(F.col("dim") == dim).select("vec_id", "n_copies", "unit")
        part = scratch.keep(_links_of(scratch, part, dim, options), f"found{dim}")
        found = part if found is None else found.union(part)
    own = F.col("vec_id")
    none = F.lit(0).cast("long")
    if found is None:
        return units.select("vec_id", none.alias("n_links"), own.alias("component_id"), F.lit(True).alias("kept"))
    groups = components(scratch, found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n_others"))
    linked = classes.drop("unit").join(counts, "vec_id", "left")
    linked = linked.join(groups.withColumnRenamed("id", "vec_id"), "vec_id", "left").select(
        "dim",
        "digest",
        (F.col("n_copies") - 1 + F.coalesce("n_others", none)).alias("n_links"),
        F.coalesce("component", "vec_id").alias("component"),
    )
    out = units.select("vec_id", "dim", "digest").join(linked, ["dim", "digest"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", none).alias("n_links"),
        component.alias("component_id"),
        (own == component).alias("kept"),
    )
