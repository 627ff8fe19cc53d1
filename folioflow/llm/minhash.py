"""Near-duplicate documents by MinHash.

A document is the set of its distinct word shingles.  Each distinct set is one node, with a number of its own.  Many
universal hashes a*x+b give each node a signature of minima, cut into bands; nodes that share a band are
candidates.  Every bucket is first compared with one hub, the member that meets most others; a large
group of copies so takes one comparison per member.  Buckets that still hold several components are
gathered to clusters, whose members of different components are compared in blocks of bounded size.
Signatures decide what may be similar; each link is confirmed on the full sets.  Components follow
from alternating large-star and small-star.

With BANDS x ROWS hashes a pair of similarity 0.8 shares no band once in two million times.  A pair of that
similarity has agreeing minima in fewer than MAYBE of all with a probability under 1e-6.

Defined results: null and empty texts and texts without words have empty sets, link with nothing and
are their own component; so are rows without an id, whose component is null.  Repeated rows get the same
result each; rows of one id with different texts are different documents, each with the links of its own text.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as T
from ._shared import table
from .components import connected_components

BANDS, ROWS = 48, 6
HASHES = BANDS * ROWS
MAYBE = 0.68
#: Characters of text, and members, of a block when the members of a cluster are compared.
BLOCK, MEMBERS = 4_000_000, 512

_rng = np.random.default_rng(71)
_A = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_FOLD = _rng.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def shingle_sets(part: T.Part, words: int) -> list[np.ndarray]:
    """Each row's distinct shingles as sorted 64-bit hashes; one of the whole text if it has fewer words."""
    data = T.LOWER[part.data]
    found = T.find_words(data, part.offsets, T.SPACED)
    h, first = T.hash_words(data, found, T.SPACED), found.first
    windows = np.zeros(max(h.size - words + 1, 0), dtype=np.uint64)
    for k in range(words):
        windows = windows * np.uint64(0xFF51AFD7ED558CCD) + h[k : k + windows.size]
    windows = T.mix64(windows)
    out = []
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        if hi - lo >= words:
            out.append(np.unique(windows[lo : hi - words + 1]))
        elif hi > lo:
            whole = np.full(1, hi - lo, dtype=np.uint64)
            for x in h[lo:hi]:
                whole = T.mix64(whole ^ x) * np.uint64(3)
            out.append(whole)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minima of all hashes."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for lo in range(0, x.size, 512):
        np.minimum(out, (_A[:, None] * x[None, lo : lo + 512] + _B[:, None]).min(axis=1), out=out)
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band."""
    return T.mix64((minima.reshape(BANDS, ROWS).astype(np.uint64) * _FOLD).sum(axis=1) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B9)).astype(np.int64)


def sketch(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_id (16 bytes, null for an empty set), bands, and the lowest byte of each minimum.

    docs: doc_id, text_key, text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, bands, low = [], [], [], []
            for part in T.parts(batch.column(2)):
                for s in shingle_sets(part, words):
                    sizes.append(s.size)
                    if s.size:
                        minima = signature(s)
                        ids.append(hashlib.md5(s.tobytes()).digest())
                        bands.append(band_keys(minima))
                        low.append(minima.astype(np.uint8).tobytes())
                    else:
                        ids.append(None)
                        bands.append(None)
                        low.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(low, pa.binary())], names=["doc_id", "text_key", "n_shingles", "set_id", "bands", "low"])

    return docs.mapInArrow(run, "doc_id long, text_key long, n_shingles long, set_id binary, bands array<long>, low binary")


def _confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets have 100 * intersection >= percent * union.  texts: node, text, low."""
    with_v = pairs.join(texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"), F.col("low").alias("low_v")), "v")
    both = with_v.join(texts.select(F.col("node").alias("u"), F.col("text").alias("text_u"), F.col("low").alias("low_u")), "u")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in batches:
            u, v = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            low_u, low_v = batch.column(4), batch.column(5)
            maybe = np.array([(np.frombuffer(a.as_buffer(), np.uint8) == np.frombuffer(b.as_buffer(), np.uint8)).mean() >= MAYBE for a, b in zip(low_u, low_v, strict=True)], dtype=bool)
            good = np.zeros(len(u), dtype=bool)
            kept = np.flatnonzero(maybe)
            at = 0
            for part in T.parts(batch.column(3).take(pa.array(kept))) if kept.size else ():
                for s in shingle_sets(part, words):
                    i = kept[at]
                    at += 1
                    if u[i] != last:
                        last, last_set = u[i], next(x for p in T.parts(batch.column(2).slice(i, 1)) for x in shingle_sets(p, words))
                    common = np.intersect1d(s, last_set, assume_unique=True).size
                    good[i] = 100 * common >= percent * (s.size + last_set.size - common)
            yield pa.RecordBatch.from_arrays([pa.array(u[good]), pa.array(v[good])], names=["u", "v"])

    return both.select("u", "v", "text_u", "text_v", "low_u", "low_v").mapInArrow(run, "u long, v long")


def _links_across(members: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (u, v) between different components of one cluster.  members: cluster, node, component, low, text.

    Clusters are cut into blocks of bounded size, and each pair of blocks is compared in one place: first the
    signatures, then, of pairs that may be similar, the full sets.  Of links between the same two
    components one is enough, so at most one row comes out for each member."""
    sizes = members.groupBy("cluster").agg(F.sum(F.length("text")).alias("size"), F.count(F.lit(1)).alias("members"))
    blocks = F.ceil(F.greatest(F.lit(1), F.col("size") / BLOCK, F.col("members") / MEMBERS)).cast("int")
    dealt = members.join(sizes, "cluster").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "component", "low", "text")

    def compare(rows: list[tuple], i: int, j: int) -> Iterator[tuple[int, int]]:
        """rows: (block, node, component, low, text) of the blocks i and j."""
        first, second = ([r for r in rows if r[0] == k] for k in (i, j))
        if not first or not second:
            return
        low = np.stack([np.frombuffer(r[3], np.uint8) for r in second])
        node, component = np.array([r[1] for r in second]), np.array([r[2] for r in second])
        sets: dict[int, np.ndarray] = {}
        top: dict[int, int] = {}

        def root(x: int) -> int:
            while top.get(x, x) != x:
                x = top[x]
            return x

        def shingles(r: tuple) -> np.ndarray:
            if r[1] not in sets:
                sets[r[1]] = next(x for p in T.parts(pa.array([r[4]])) for x in shingle_sets(p, words))
            return sets[r[1]]

        for r in first:
            near = ((low == np.frombuffer(r[3], np.uint8)).mean(axis=1) >= MAYBE) & (component != r[2])
            if i == j:
                near &= node > r[1]
            for k in np.flatnonzero(near):
                a, b = root(r[2]), root(second[k][2])
                if a == b:
                    continue
                s, t = shingles(r), shingles(second[k])
                if 100 * min(s.size, t.size) < percent * max(s.size, t.size):
                    continue
                common = np.intersect1d(s, t, assume_unique=True).size
                if 100 * common >= percent * (s.size + t.size - common):
                    top[max(a, b)] = min(a, b)
                    yield r[1], second[k][1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []

        def flush() -> pa.RecordBatch:
            found = list(compare(rows, group[1], group[2])) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["u", "v"])

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                for *key, block, node, component, low, text in zip(*(c.to_pylist() for c in batch.slice(lo, 256).columns), strict=True):
                    if key != group:
                        if rows:
                            yield flush()
                        group, rows = key, []
                    rows.append((block, node, component, low, text))
        if rows:
            yield flush()

    return dealt.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j").mapInArrow(run, "u long, v long")


def classes(docs: DataFrame, *, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of docs: doc_id, text_key (a hash of its text), n_shingles, component_id (the smallest id reachable), and chosen.

    chosen holds for the rows of one id and text of each component, and for rows that link with nothing."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    sketched = table(sketch(docs, words), "sketches")
    linked = sketched.where("set_id is not null and doc_id is not null").withColumn("own", F.struct("doc_id", "text_key"))
    # one node for each distinct set, with its first document
    sets = table(linked.groupBy("set_id").agg(F.min("own").alias("own")).withColumn("node", F.monotonically_increasing_id()), "sets")
    nodes = linked.join(sets, ["set_id", "own"]).select("node", "own", "bands", "low").dropDuplicates(["node"])
    bands = nodes.select("node", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = table(bands.join(shared, "key"), "buckets")
    degree = members.groupBy("node").agg(F.sum("n").alias("degree"))
    ranked = members.join(degree, "node")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("degree", (-F.col("node")).alias("m"))).alias("hub")).select("key", (-F.col("hub.m")).alias("hub"))
    hubs = table(hubs, "hubs")
    pairs = table(members.join(hubs, "key").where("node <> hub").select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct(), "pairs")
    lows = nodes.join(members.select("node").distinct(), "node", "left_semi").select("own.doc_id", "own.text_key", "node", "low")
    texts = table(docs.join(lows, ["doc_id", "text_key"]).select("node", "text", "low").dropDuplicates(["node"]), "candidates")
    edges = table(_confirm(pairs, texts, words, percent), "links")
    component = connected_components(edges)
    # buckets that hold several components besides their hub's pairs, which are compared already
    labelled = members.join(hubs, "key").where("node <> hub").select("key", "node").join(component, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    labelled = table(labelled, "labelled")
    mixed = labelled.groupBy("key").agg(F.min("node").alias("u"), F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("key", "u")
    rest = table(labelled.join(mixed, "key").select("u", "node", "component").distinct(), "mixed")
    clusters = connected_components(rest.select("u", F.col("node").alias("v"))).withColumnRenamed("component", "cluster")
    rest = rest.select("node", "component").distinct().join(clusters, "node", "left").withColumn("cluster", F.coalesce("cluster", "node"))
    late = table(_links_across(rest.join(texts, "node"), words, percent), "links")
    if late.head(1):
        component = connected_components(edges.unionAll(late))
    # as tables of their own, so that the rows of one component or one set with very many copies can be split in the joins
    found = table(sets.join(component, "node", "left").select("set_id", "own", F.coalesce("component", "node").alias("component")), "components")
    least = table(found.groupBy("component").agg(F.min("own").alias("least")), "least")
    known = table(found.join(least, "component").select("set_id", "least"), "classes")
    out = sketched.join(known, "set_id", "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("least.doc_id", "doc_id"))
    chosen = F.coalesce((F.col("doc_id") == F.col("least.doc_id")) & (F.col("text_key") == F.col("least.text_key")), F.lit(True))
    return out.select("doc_id", "text_key", "n_shingles", own.alias("component_id"), chosen.alias("chosen"))


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of docs: doc_id, n_shingles, component_id (smallest id reachable), kept (it is the smallest)."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return classes(docs, words=words, percent=percent, id_col=id_col, text_col=text_col).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all documents, by shingles of four words and similarity 0.8."""
    return near_duplicates(T.spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")), words=4)


SQL = r"""with recursive lowered as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
sets as (select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 2), lambda k: array_to_string(w[k:k + 3], ' '))) end s from lowered),
shingles as (select doc_id, unnest(s) x from sets),
common as (select a.doc_id u, b.doc_id v, count(*) n from shingles a join shingles b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
links as (select u, v from common join sets a on a.doc_id = u join sets b on b.doc_id = v where 100 * n >= 80 * (len(a.s) + len(b.s) - n)),
edges as (select u, v from links union all select v, u from links),
reach(a, b) as (select doc_id, doc_id from documents union select reach.a, edges.v from reach join edges on edges.u = reach.b),
least as (select a, min(b) c from reach group by 1)
select doc_id, cast(len(s) as bigint) n_shingles, c component_id, doc_id = c kept from sets join least on a = doc_id"""
