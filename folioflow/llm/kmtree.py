"""Nearest neighbours by a hierarchical k-means tree.

A tree of k-means clusters is fitted to a bounded sample; every distinct vector goes to the leaf that it reaches by
the nearest child at each level.  A query walks the tree best-bin-first: a priority queue holds the
branches not taken, by distance to their centroids, and leaves are visited in the order in which it yields
them.  How many leaves a query visits is calibrated: on sampled queries, compared with all vectors, it
grows until the recall aimed at is reached; visits also go on until enough vectors are seen.
Within a leaf distances are computed in double precision on the vectors as they are.

Equal vectors are one entry with its smallest ids, of which no more can be among the nearest.  Leaves are read
in shards of bounded size; each sends back the nearest of the leaves that a query visits.

Defined results: vectors that are null, zero or hold null or non-finite components, and rows without an id, take no
part.  A query with fewer candidates gets all of them.  Ties go to the smaller id.  Vectors of different lengths
are not compared.  Repeated rows are one.  Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _text as T
from ._shared import table
from ._vectors import dimensions, groups, stack, usable

#: Vectors of the sample that the tree is fitted to; most leaves; vectors that a leaf should have; children of a node.
SAMPLE, LEAVES, LEAF_SIZE, BRANCH = 16_000, 4096, 200, 8
#: Recall aimed at, and queries that it is calibrated with.
RECALL, CALIBRATION = 0.985, 128
#: Vectors of a shard: leaves that are read together.  Queries that a shard answers in one task.
BLOCK, QUERIES = 4096, 4096


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = x[np.sort(rng.choice(len(x), k, replace=False))].copy()
    for _ in range(rounds):
        own = ((centres**2).sum(axis=1)[None, :] - 2 * x @ centres.T).argmin(axis=1)
        counts = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


@dataclass
class Tree:
    """centres of all nodes; children of each, none for leaves; leaf numbers, -1 for inner nodes."""

    centres: np.ndarray
    children: list[np.ndarray]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at = np.zeros(len(x), dtype=np.int64)
        while True:
            inner = np.unique(at[self.leaf[at] < 0])
            if not inner.size:
                return self.leaf[at]
            for node in inner:
                rows, kids = np.flatnonzero(at == node), self.children[node]
                c = self.centres[kids]
                at[rows] = kids[((c**2).sum(axis=1)[None, :] - 2 * x[rows] @ c.T).argmin(axis=1)]

    def visits(self, x: np.ndarray, least: int, sizes: np.ndarray, enough: int) -> list[int]:
        """Leaves for one vector, best bins first: at least so many, and until they hold enough vectors."""
        queue, found, seen = [(0.0, 0)], [], 0
        while queue and (len(found) < least or seen < enough):
            _, node = heapq.heappop(queue)
            while self.leaf[node] < 0:
                kids = self.children[node]
                far = ((self.centres[kids] - x) ** 2).sum(axis=1)
                best = int(far.argmin())
                for k, d in zip(kids.tolist(), far.tolist(), strict=True):
                    if k != kids[best]:
                        heapq.heappush(queue, (d, k))
                node = int(kids[best])
            found.append(int(self.leaf[node]))
            seen += int(sizes[found[-1]])
        return found


def fit(x: np.ndarray, leaves: int, branch: int = BRANCH, seed: int = 5) -> Tree:
    """Split the cluster of most rows until there are so many leaves."""
    rng = np.random.default_rng(seed)
    centres, children, members = [x.mean(axis=0) if len(x) else np.zeros(x.shape[1])], [np.zeros(0, dtype=np.int64)], {0: np.arange(len(x))}
    queue, n_leaves = [(-len(x), 0)], 1
    while queue and n_leaves < leaves:
        size, node = heapq.heappop(queue)
        k = min(branch, leaves - n_leaves + 1, -size // 4)
        if k < 2:
            continue
        rows = members.pop(node)
        c = _kmeans(x[rows], k, rng)
        own = ((c**2).sum(axis=1)[None, :] - 2 * x[rows] @ c.T).argmin(axis=1)
        used = np.flatnonzero(np.bincount(own, minlength=k))
        if used.size < 2:
            members[node] = rows
            continue
        children[node] = np.arange(len(centres), len(centres) + used.size)
        for j in used:
            members[len(centres)] = rows[own == j]
            heapq.heappush(queue, (-len(members[len(centres)]), len(centres)))
            centres.append(c[j])
            children.append(np.zeros(0, dtype=np.int64))
        n_leaves += used.size - 1
    leaf = np.full(len(centres), -1)
    ends = [i for i, c in enumerate(children) if not c.size]
    leaf[ends] = np.arange(len(ends))
    return Tree(np.array(centres), children, leaf)


def _top(queries: np.ndarray, x: np.ndarray, ids: list[list[int]], k: int, seen: np.ndarray | None = None) -> Iterator[tuple[int, int, float, int]]:
    """For each query, its k nearest ids among the rows that it sees (queries x rows): (query, id, distance, row), ties to smaller ids."""
    norms = (x**2).sum(axis=1)
    for lo in range(0, len(queries), 64):
        some = queries[lo : lo + 64]
        rough = norms[None, :] - 2 * some @ x.T
        if seen is not None:
            rough[~seen[lo : lo + 64]] = np.inf
        limits = np.partition(rough, k - 1, axis=1)[:, k - 1] if rough.shape[1] > k else np.full(len(some), np.inf)
        for i, row in enumerate(rough):
            # the rough distances err by rounding only; the margin is far beyond it
            limit = limits[i]
            near = np.flatnonzero((row <= limit + 1e-9 * (1 + abs(limit) + norms.max())) & (row < np.inf) if limit < np.inf else row < np.inf)
            exact = np.sqrt(((x[near] - some[i]) ** 2).sum(axis=1))
            found = sorted((float(d), v, int(r)) for d, r in zip(exact, near, strict=True) for v in ids[r])[:k]
            for d, v, r in found:
                yield lo + i, v, d, r


def _search(dealt: DataFrame, asked: DataFrame, number: np.dtype, k: int) -> DataFrame:
    """query (vec), vec_id, score: the k nearest of each query among the leaves that it visits in each shard.

    dealt: shard, part, leaf, vec, ids.  asked: shard, part, query, leaves.  A part is a share of the queries."""

    def run(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        given, out = queries.column("query").to_pylist(), []
        if given and rows.num_rows:
            x, q, ids = stack(rows.column("vec").to_pylist(), number), stack(given, number), rows.column("ids").to_pylist()
            there, leaf = np.unique(rows.column("leaf").to_numpy(), return_inverse=True)
            visited = np.stack([np.isin(there, leaves) for leaves in queries.column("leaves").to_pylist()])
            out = [(i, v, d) for i, v, d, _ in _top(q, x, ids, k, visited[:, leaf])]
        return pa.table({"query": pa.array([given[r[0]] for r in out], pa.binary()), "vec_id": pa.array([r[1] for r in out], pa.int64()), "score": pa.array([r[2] for r in out], pa.float64())})

    return dealt.groupBy("shard", "part").cogroup(asked.groupBy("shard", "part")).applyInArrow(run, "query binary, vec_id long, score double")


def shards(sizes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """First shard and number of shards of each leaf: neighbouring leaves share a shard of block vectors, a larger leaf has several."""
    first, count, at, held = np.zeros(len(sizes), dtype=np.int64), np.ones(len(sizes), dtype=np.int64), 0, 0
    for leaf, n in enumerate(sizes):
        if held and held + n > block:
            at, held = at + 1, 0
        first[leaf], count[leaf] = at, max(1, -(-n // block))
        held += n
        if count[leaf] > 1:
            at, held = at + count[leaf], 0
    return first, count


def _calibrate(entries: DataFrame, tree: Tree, sizes: np.ndarray, number: np.dtype, k: int, recall: float, queries: int) -> int:
    """The number of leaves to visit.  Sampled vectors are compared with all entries, in one pass that keeps the k + 1 nearest of each."""
    sample = [r["vec"] for r in entries.select("vec").orderBy(F.xxhash64("vec")).limit(queries).collect()]
    q = stack(sample, number)

    def nearest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[float, int, int]]] = {i: [] for i in range(len(q))}
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                some = batch.slice(lo, 2048)
                leaf, ids = some.column(0).to_pylist(), some.column(2).to_pylist()
                for i, v, d, r in _top(q, stack(some.column(1).to_pylist(), number), ids, k + 1):
                    best[i].append((d, v, leaf[r]))
                best = {i: sorted(b)[: k + 1] for i, b in best.items()}
        rows = [(i, *x) for i, b in best.items() for x in b]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int32(), pa.float64(), pa.int64(), pa.int32()))], names=["query", "score", "vec_id", "leaf"])

    rows = entries.select("leaf", "vec", "ids").mapInArrow(nearest, "query int, score double, vec_id long, leaf int")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
    needed = []
    found = rows.withColumn("rank", rank).where(F.col("rank") <= k + 1).collect()  # queries x (k + 1) rows
    order = {}
    for r in found:
        if r["query"] not in order:
            walk = tree.visits(q[r["query"]], tree.leaves, sizes, 0)
            order[r["query"]] = {leaf: i for i, leaf in enumerate(walk)}
        if r["rank"] > 1:  # the first is the query itself
            needed.append(order[r["query"]][r["leaf"]] + 1)
    if not needed:
        return tree.leaves
    needed.sort()
    return needed[min(int(np.ceil(recall * len(needed))), len(needed)) - 1]


def nearest(df: DataFrame, is_query: Column, *, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows of each row where is_query (of vec_id) holds, by Euclidean distance."""
    vectors, number = usable(df, id_col, vector_col)
    vectors = table(vectors, "vectors")
    # of equal vectors, the k + 1 smallest ids: also without the query's own, k are left
    rank = F.dense_rank().over(Window.partitionBy("vec").orderBy("vec_id"))
    entries = vectors.withColumn("rank", rank).where(F.col("rank") <= k + 1).groupBy("vec").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"), F.first("dim").alias("dim"))
    entries = table(entries, "entries")
    out = None
    for dim in dimensions(entries):
        part = _nearest(entries.where(F.col("dim") == dim).select("vec", "ids"), vectors.where((F.col("dim") == dim) & is_query).select("vec_id", "vec").distinct(), number, k, recall, sample)
        out = part if out is None else out.unionAll(part)
    return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double") if out is None else out


def _nearest(entries: DataFrame, queries: DataFrame, number: np.dtype, k: int, recall: float, sample: int) -> DataFrame:
    n = entries.count()
    drawn = [r["vec"] for r in T.bounded_sample(entries, F.col("vec"), sample, n).select("vec").collect()]
    tree = fit(stack(sorted(drawn), number), max(1, min(LEAVES, n // LEAF_SIZE, len(drawn) // 8)))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.assign(stack(batch.column(0).to_pylist(), number)) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), *batch.columns], names=["leaf", "vec", "ids"])

    indexed = table(entries.mapInArrow(place, "leaf int, vec binary, ids array<long>"), "index")
    sizes, stored = np.zeros(tree.leaves, dtype=np.int64), np.zeros(tree.leaves, dtype=np.int64)
    for r in indexed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("ids")).collect():  # at most LEAVES rows
        sizes[r["leaf"]], stored[r["leaf"]] = r["n"], r["ids"]
    first, count = shards(sizes, BLOCK)
    least = _calibrate(indexed, tree, stored, number, k, recall, CALIBRATION)

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                vecs, rows = batch.column(0).slice(lo, 256).to_pylist(), []
                for vec, x in zip(vecs, stack(vecs, number), strict=True):
                    visited: dict[int, list[int]] = {}
                    for leaf in tree.visits(x, least, stored, k + 1):
                        for s in range(first[leaf], first[leaf] + count[leaf]):
                            visited.setdefault(s, []).append(leaf)
                    rows += [(s, vec, leaves) for s, leaves in visited.items()]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), pa.binary(), pa.list_(pa.int32())))], names=["shard", "query", "leaves"])

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = batch.column(0).to_numpy()
            part = np.array([zlib.crc32(v.as_buffer()) for v in batch.column(1)], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(first[leaf] + part % count[leaf]), *batch.columns], names=["shard", *batch.schema.names])

    dealt = indexed.mapInArrow(deal, "shard long, leaf int, vec binary, ids array<long>")
    asked = table(queries.select("vec").distinct().mapInArrow(ask, "shard long, query binary, leaves array<int>"), "asked")
    parts = max(1, -(-asked.select("query").distinct().count() // QUERIES))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts)))
    dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    found = _search(dealt, asked, number, k + 1)
    best = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
    found = found.withColumn("r", best).where(F.col("r") <= k + 1).select(F.col("query").alias("vec"), F.col("vec_id").alias("found"), "score")
    pairs = queries.join(found, "vec").where("found <> vec_id")
    rank = F.row_number().over(Window.partitionBy("vec_id").orderBy("score", "found"))
    pairs = pairs.withColumn("rank", rank).where(F.col("rank") <= k)
    return pairs.select(F.col("vec_id").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("found").alias("vec_id"), "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest embeddings of every hundredth one."""
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(df, F.col("vec_id") % 100 == 0)
