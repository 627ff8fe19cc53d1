"""Near-duplicates of texts and vectors against brute force; components; odd inputs."""

import itertools
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioflow import llm
from folioflow.llm import _vectors, lattice, minhash
from folioflow.llm.components import connected_components


DATA = "/root/testdata/sf0.001"


def brute(docs, words, percent):
    low = str.maketrans({c: c + 32 for c in range(65, 91)})
    sets = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i] = frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])
    top = {i: i for i in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            p, q = root(a), root(b)
            top[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def family(seed, n, size, edits):
    """Near copies of one text with few or many edits each."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.choice(edits)):
            words[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("words", [4, 5])
def test_minhash_equals_brute_force(spark, words):
    texts = family(1, 40, 120, (0, 1, 2, 3, 4, 6)) + family(2, 25, 60, (0, 1, 2)) + [None, "", " \n", "a b", "A b", "a b c", "one two three four", "x " * 4000] + family(3, 5, 3000, (0, 40, 200))
    docs = list(enumerate(texts, 10))
    random.Random(5).shuffle(docs)
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, component_id long").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, words=words).collect()}
    assert got == brute(docs, words, 80)


@pytest.mark.parametrize(("size", "members"), [(20_000, 512), (4_000_000, 7)])
def test_minhash_blocks_equal_whole(spark, monkeypatch, size, members):
    docs = list(enumerate(family(7, 60, 80, (3, 5, 8))))
    monkeypatch.setattr(minhash, "BLOCK", size)
    monkeypatch.setattr(minhash, "MEMBERS", members)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=4).collect()}
    assert got == brute(docs, 4, 80)


def test_minhash_repeated_rows_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "A b c d e f")], "doc_id long, text string")
    rows = sorted(((r.doc_id or 0), r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    assert rows == [(0, None, True), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert minhash.near_duplicates(df.where("doc_id > 5")).count() == 0
    assert minhash.near_duplicates(df.where("doc_id = 2")).first().kept


def test_minhash_one_id_with_different_texts(spark):
    """Each text has its own links: 1 is a copy of 2 by its one text, and of 3 by its other."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (5, c), (5, c), (4, c + " z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df, words=4).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 4, False), (5, 4, False)]
    chosen = sorted((r.doc_id, r.chosen) for r in minhash.classes(df, words=4).collect())
    assert chosen == [(1, True), (1, True), (2, False), (3, False), (4, True), (5, False), (5, False)]


def duck(table, sql):
    con = duckdb.connect()
    con.sql(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    return sorted(con.sql(sql).fetchall())


def test_queries_equal_their_sql(spark):
    for name, table in (("op5_lattice", "embeddings"), ("op6_minhash", "documents")):
        df = llm.queries()[name](spark, DATA)
        assert sorted(map(tuple, df.collect())) == duck(table, llm.oracle_sql()[name])


def test_components_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, 100 + k) for k in range(1, 50)] + [(130, 131), (131, 130), (120, 120)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain + star, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{100 + k: 100 for k in range(1, 50)}}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def vectors():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 32))
    rows = [(int(i), (base[i % 6] + rng.normal(size=32) * rng.choice([0.02, 0.2, 0.35])).tolist()) for i in range(200)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, [3 * x for x in rows[0][1]]), (303, [0.0] * 32), (304, None), (305, [None, *rows[0][1][1:]]), (306, [float("nan"), *rows[0][1][1:]]), (307, [1.0, 2.0]), (308, [2.0, 4.0]), (309, [])]
    return rows


@pytest.mark.parametrize("kind", ["float", "double"])
def test_lattice_equals_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(lattice, "BLOCK", 40)
    rows = vectors()
    df = spark.createDataFrame([(i, v, 5) for i, v in rows], f"vec_id long, embedding array<{kind}>, n_links int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in lattice.near_duplicates(df).collect()}
    good = {i: np.array(v, dtype=np.float32 if kind == "float" else np.float64).astype(float) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    link = {i: set() for i, _ in rows}
    for a, b in itertools.combinations(good, 2):
        if len(good[a]) == len(good[b]) and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.9:
            link[a].add(b)
            link[b].add(a)
    for i in link:
        seen, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        assert got[i] == (len(link[i]), min(seen), min(seen) == i), i


def test_lattice_finds_what_it_promises():
    """Of pairs of cosine 0.9 at least 0.997 meet in a cell, of pairs of cosine 0.95 all but one in 2,000."""
    rng = np.random.default_rng(8)
    for dim in (32, 64, 256):
        one, other = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in rng.normal(size=(2, 4000, dim)))
        across = other - (one * other).sum(axis=1, keepdims=True) * one
        across /= np.linalg.norm(across, axis=1, keepdims=True)
        for cosine, least in ((0.9, 0.997), (0.95, 0.9995)):
            (h, v), (g, w) = (lattice.cells(x, lattice.TABLES, lattice.PROBES, lattice.WIDTH) for x in (one, cosine * one + np.sqrt(1 - cosine**2) * across))
            met = (h == g) | (v == g[:, :, None]).any(axis=2) | (w == h[:, :, None]).any(axis=2)
            assert met.any(axis=1).mean() >= least


def test_lattice_decodes_to_nearest_points():
    rng = np.random.default_rng(1)
    y = rng.normal(size=(50, 8)) * 2
    near = lattice.decode(y)
    for r in lattice._ROOTS:
        assert (((y - near) ** 2).sum(axis=1) <= ((y - near - r) ** 2).sum(axis=1) + 1e-9).all()
    whole = (near == np.rint(near)).all(axis=1)
    assert (whole | ((near - 0.5) == np.rint(near - 0.5)).all(axis=1)).all() and (near.sum(axis=1) % 2 == 0).all()


def test_lattice_empty_tables(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert lattice.near_duplicates(df).count() == 0
    one = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.near_duplicates(one).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert lattice.near_duplicates(one.withColumn("extra", F.lit(1))).columns == ["vec_id", "n_links", "component_id", "kept"]


def test_runs_of_batches_cut_anywhere():
    rng = np.random.default_rng(8)
    keys = np.sort(rng.integers(0, 9, 60))
    other = rng.integers(0, 2, 60)
    order = np.lexsort((other, keys))
    keys, other, vecs = keys[order], other[order], rng.normal(size=(60, 3))
    rows = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(other), pa.array([v.tobytes() for v in vecs], pa.binary())], names=["a", "b", "v"])
    for size in (1, 7, 60):
        found = list(_vectors.runs([rows.slice(0, 0)] + [rows.slice(lo, size) for lo in range(0, 60, size)], 2))
        assert [k for k, _ in found] == sorted(set(zip(keys.tolist(), other.tolist())))
        assert np.array_equal(np.vstack([_vectors.matrix(r.column(2), np.dtype("<f8")) for _, r in found]), vecs)
        assert all(set(zip(r.column(0).to_pylist(), r.column(1).to_pylist())) == {k} for k, r in found)
    assert list(_vectors.runs([], 2)) == []
