"""Near-duplicate vectors by E8 lattice hashing.

Equal vectors are one node.  In each of TABLES tables a unit vector is projected at random to eight dimensions and
decoded to the nearest point of the E8 lattice, its home cell; it also visits the PROBES neighbouring points
nearest to it.  Within a cell those at home are compared with all who are there, in blocks of bounded size, by
cosine in double precision.  A pair that meets in several cells counts in the first of them, so each
cell sends back only sums per node, and a spanning forest of its links.

With these parameters a pair of cosine 0.9 meets in at least one table with a probability of about 0.999 (a test
measures it), one of cosine 0.95 nearly always.  Every vector travels TABLES * (PROBES + 1) times; more tables with few
neighbours need fewer copies than few tables with many neighbours for the same share of pairs found.

Defined results: vectors that are null, zero or hold null or non-finite components, and rows without an id, link with
nothing.  Vectors of different lengths are not compared.  Rows with the same id and vector are one vector, and each
gets its result.  Extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as T
from ._shared import table
from ._vectors import dimensions, matrix, runs, usable
from .components import connected_components

TABLES, PROBES, WIDTH = 10, 1, 2.0
#: Members of a block when a cell is compared.
BLOCK = 1024


def _neighbours() -> np.ndarray:
    """The 240 shortest vectors of the lattice."""
    whole = [tuple(s * (k == i) + t * (k == j) for k in range(8)) for i, j in itertools.combinations(range(8), 2) for s in (1, -1) for t in (1, -1)]
    half = [s for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(whole + half)


_ROOTS = _neighbours()
_FOLD = np.random.default_rng(97).integers(0, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)


def _even(y: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum: where it is odd, the worst rounding goes the other way."""
    near = np.rint(y)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    worst = np.abs(y[odd] - near[odd]).argmax(axis=1)
    near[odd, worst] += np.where(y[odd, worst] >= near[odd, worst], 1, -1)
    return near


def decode(y: np.ndarray) -> np.ndarray:
    """The nearest E8 points: the better of the even integer points and those moved by one half."""
    whole, half = _even(y), _even(y - 0.5) + 0.5
    return np.where((((y - whole) ** 2).sum(axis=1) <= ((y - half) ** 2).sum(axis=1))[:, None], whole, half)


def _codes(points: np.ndarray) -> np.ndarray:
    """A 64-bit number of each lattice point."""
    return T.mix64(((2 * points).astype(np.int64).astype(np.uint64) * _FOLD).sum(axis=-1)).astype(np.int64)


def cells(unit: np.ndarray, tables: int, probes: int, width: float, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Home codes (n x tables) and visited codes (n x tables x probes)."""
    homes, visits = [], []
    for t in range(first, tables):
        y = unit @ np.random.default_rng((131, t, unit.shape[1])).normal(size=(unit.shape[1], 8)) / width
        point = decode(y)
        # |y - p - r|^2 grows with |r|^2 / 2 - (y - p) r, and all |r| are equal
        nearest = np.argsort(-((y - point) @ _ROOTS.T), axis=1, kind="stable")[:, :probes]
        homes.append(_codes(point))
        visits.append(_codes(point[:, None, :] + _ROOTS[nearest]))
    return np.stack(homes, axis=1), np.stack(visits, axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _links(dealt: DataFrame, number: np.dtype, least: float, tables: int, probes: int, width: float) -> DataFrame:
    """node, other, n: a link (n null), or how much n_links of a node grows (other null).

    dealt: table, cell, i, j, block, home, node, copies, vec."""

    def compare(t: int, cell: int, i: int, j: int, rows: pa.RecordBatch) -> Iterator[tuple]:
        block, home, node, copies = (rows.column(k).to_numpy(zero_copy_only=False) for k in range(4, 8))
        one, two = np.flatnonzero(block == i), np.flatnonzero(block == j)
        if not one.size or not two.size or not home.any():
            return
        x = matrix(rows.column(8), number)
        norm = np.linalg.norm(x, axis=1)
        rough = (x / norm[:, None]).astype(np.float32)
        near = rough[one] @ rough[two].T >= least - 1e-3
        near &= home[one][:, None] | home[two][None, :]
        if i == j:
            near &= node[one][:, None] < node[two][None, :]
        a, b = np.nonzero(near)
        a, b = one[a], two[b]
        a, b = np.where(node[a] < node[b], a, b), np.where(node[a] < node[b], b, a)
        keep = np.einsum("ij,ij->i", x[a], x[b]) / (norm[a] * norm[b]) >= least
        a, b = a[keep], b[keep]
        if not a.size:
            return
        # a pair counts in the first table where it meets, and there in the smallest cell
        some, index = np.unique(np.concatenate((a, b)), return_inverse=True)
        homes, visits = cells(_unit(x[some]), t + 1, probes, width)
        u, v = index[: a.size], index[a.size :]
        where = np.full(a.size, -1)
        for k in range(t, -1, -1):
            there = np.stack((np.where((homes[v, k][:, None] == visits[u, k]).any(axis=1) | (homes[u, k] == homes[v, k]), homes[v, k], np.iinfo(np.int64).max), np.where((homes[u, k][:, None] == visits[v, k]).any(axis=1), homes[u, k], np.iinfo(np.int64).max)))
            cell_of = there.min(axis=0)
            met = cell_of != np.iinfo(np.int64).max
            where = np.where(met, k, where)
            if k == t:
                here = cell_of == cell
        own = here & (where == t)
        a, b = a[own], b[own]
        grow = np.bincount(a, copies[b], minlength=rows.num_rows) + np.bincount(b, copies[a], minlength=rows.num_rows)
        for k in np.flatnonzero(grow):
            yield int(node[k]), None, int(grow[k])
        top = np.arange(rows.num_rows)

        def root(k: int) -> int:
            while top[k] != k:
                top[k] = top[top[k]]
                k = top[k]
            return k

        for k, m in zip(a.tolist(), b.tolist(), strict=True):
            r, s = root(k), root(m)
            if r != s:
                top[s] = r
                yield int(node[k]), int(node[m]), None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for (t, cell, i, j), rows in runs(batches, 4):
            if rows.num_rows > 1:
                found += compare(t, cell, i, j, rows)
            if len(found) > 10_000:
                yield _batch(found)
                found = []
        yield _batch(found)

    return dealt.repartition("table", "cell", "i", "j").sortWithinPartitions("table", "cell", "i", "j").mapInArrow(run, "node long, other long, n long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["node", "other", "n"])


def near_duplicates(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9, tables: int = TABLES, probes: int = PROBES, width: float = WIDTH) -> DataFrame:
    """For each row of df: vec_id, n_links (other vectors of cosine least or more), component_id (smallest id reachable), kept (it is the smallest)."""
    vectors, number = usable(df, id_col, vector_col)
    vectors = table(vectors.dropDuplicates(["vec_id", "vec"]), "vectors")
    nodes = table(vectors.groupBy("vec").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("dim").alias("dim")), "nodes")
    found = None
    for dim in dimensions(nodes):

        def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo in range(0, batch.num_rows, 1024):
                    some = batch.slice(lo, 1024)
                    homes, visits = cells(_unit(matrix(some.column(0), number)), tables, probes, width)
                    codes = np.concatenate((homes[:, :, None], visits), axis=2).reshape(-1)
                    ends = np.arange(some.num_rows + 1, dtype=np.int32) * (tables * (probes + 1))
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(codes))], names=["vec", "node", "copies", "codes"])

        # the codes of a vector lie in one row, home first in each table: they are computed once and dealt out by Spark
        coded = table(nodes.where(F.col("dim") == dim).select("vec", "node", "copies").mapInArrow(place, "vec binary, node long, copies long, codes array<long>"), "codes")
        at = F.col("at")
        placed = coded.select("vec", "node", "copies", F.posexplode("codes").alias("at", "cell")).select(F.floor(at / (probes + 1)).cast("int").alias("table"), "cell", (at % (probes + 1) == 0).alias("home"), "node", "copies", "vec")
        # cells with more members than a block are few: one for each BLOCK rows at most
        large = placed.groupBy("table", "cell").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > BLOCK)
        large = table(large.select("table", "cell", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")), "cells")
        dealt = placed.join(large, ["table", "cell"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select("table", "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "home", "node", "copies", "vec")
        links = _links(dealt, number, least, tables, probes, width)
        found = links if found is None else found.unionAll(links)
    rows = df.select(F.col(id_col).alias("vec_id"))
    if found is None:
        return _result(rows, None)
    found = table(found, "links")
    component = connected_components(found.where("n is null").select(F.col("node").alias("u"), F.col("other").alias("v")))
    grown = found.where("n is not null").groupBy("node").agg(F.sum("n").alias("grown"))
    known = nodes.join(grown, "node", "left").join(component, "node", "left").select("vec", (F.coalesce("grown", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    # an id has one result; of several vectors with one id, the sum of links and the smallest component
    by_id = vectors.join(known, "vec").groupBy("vec_id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    return _result(rows, by_id)


def _result(rows: DataFrame, by_id: DataFrame | None) -> DataFrame:
    if by_id is None:
        out = rows.withColumn("n_links", F.lit(None).cast("long")).withColumn("component_id", F.lit(None).cast("long"))
    else:
        out = rows.join(by_id, "vec_id", "left")
    own = F.coalesce("component_id", F.col("vec_id").cast("long"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(own == F.col("vec_id"), F.lit(True)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all embeddings, at cosine 0.9."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


SQL = """with recursive good as (select vec_id, cast(embedding as double[]) x from embeddings where embedding is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0 and len(list_filter(embedding, lambda v: v <> 0)) > 0),
links as (select a.vec_id u, b.vec_id v from good a join good b on a.vec_id < b.vec_id and len(a.x) = len(b.x) where list_cosine_similarity(a.x, b.x) >= 0.9),
edges as (select u, v from links union all select v, u from links),
degree as (select u, count(*) n from edges group by 1),
reach(a, b) as (select vec_id, vec_id from embeddings union select reach.a, edges.v from reach join edges on edges.u = reach.b),
least as (select a, min(b) c from reach group by 1)
select vec_id, cast(coalesce(n, 0) as bigint) n_links, c component_id, vec_id = c kept from embeddings join least on a = vec_id left join degree on u = vec_id"""
