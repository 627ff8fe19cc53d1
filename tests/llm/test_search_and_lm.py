"""Nearest neighbours and the language model against brute force."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import katz, kmtree


def test_neighbours_recall_and_order(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 24))
    x = (base[rng.integers(0, 40, 3000)] + 0.4 * rng.normal(size=(3000, 24))).astype(np.float32)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    rows = kmtree.nearest(df, F.col("vec_id") % 100 == 0).collect()
    hit = 0
    for q in range(0, 3000, 100):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        d[q] = np.inf
        true = sorted(range(3000), key=lambda i: (d[i], i))[:10]
        got = sorted((r for r in rows if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, 11)) and all(abs(r.score - d[r.vec_id]) < 1e-12 for r in got)
        assert got == sorted(got, key=lambda r: (r.score, r.vec_id))
        hit += len({r.vec_id for r in got} & set(true))
    assert hit / 300 >= 0.9


def test_neighbours_copies_ties_and_odd_vectors(spark):
    same = [1.0, 0.0, 2.0]
    rows = [(i, same) for i in range(0, 130)] + [(200, [1.0, 0.0, 3.0]), (201, None), (202, [0.0, 0.0, 0.0]), (203, [1.0, None, 2.0]), (300, [5.0, 5.0]), (400, [float("inf"), 0.0, 1.0]), (100, same)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = collections.defaultdict(list)
    for r in kmtree.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert got[0] == [(i, 0.0) for i in range(1, 11)] and got[100] == [(i, 0.0) for i in range(10)]
    assert got[200] == [(i, 1.0) for i in range(10)] and 300 not in got and 400 not in got
    few = df.where("vec_id in (0, 1, 200)")
    assert [(r.query_id, r["rank"], r.vec_id) for r in kmtree.nearest(few, F.col("vec_id") == 0).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 200)]
    assert kmtree.nearest(df.where("vec_id < 0"), F.col("vec_id") == 0).count() == 0


def test_tree_visits_every_leaf_once_in_the_end():
    x = np.random.default_rng(1).normal(size=(500, 8))
    tree = kmtree.fit(x, 30)
    sizes = np.bincount(tree.assign(x), minlength=tree.leaves)
    assert sorted(tree.visits(x[0], tree.leaves, sizes, 0)) == list(range(tree.leaves))
    assert tree.visits(x[0], 1, sizes, 0)[0] == tree.assign(x[:1])[0]
    first, count = kmtree.shards(np.array([5, 3, 30, 2, 2]), 10)
    assert first.tolist() == [0, 0, 1, 4, 4] and count.tolist() == [1, 1, 3, 1, 1]


def brute(docs, train):
    low = str.maketrans({c: c + 32 for c in range(65, 91)})
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) + [None] for i, t in docs}
    c, bi, h = collections.Counter(), collections.Counter(), collections.Counter()
    for i, t in tokens.items():
        if train(i):
            c.update(t)
            for p, w in zip(["<s>", *t], t):
                bi[p, w] += 1
                h[p] += 1
    n, v = sum(c.values()), len(c)
    count = lambda x: np.bincount(np.minimum(list(x.values()) or [0], 7), minlength=8)[:7].astype(float) * (len(x) > 0)
    du, db = katz.discounts(count(c)), katz.discounts(count(bi))
    d = lambda t, r: t[min(r, 6)]
    unknown = 1 - sum(d(du, r) * r for r in c.values()) / n if n else 1.0
    p1 = lambda w: d(du, c[w]) * c[w] / n if w in c else unknown
    after = collections.defaultdict(list)
    for (p, w), k in bi.items():
        after[p].append((w, k))
    alpha = {p: (1 - sum(d(db, k) * k for _, k in x) / h[p]) / (1 - sum(p1(w) for w, _ in x)) for p, x in after.items()}
    p2 = lambda p, w: d(db, bi[p, w]) * bi[p, w] / h[p] if (p, w) in bi else alpha.get(p, 1.0) * p1(w)
    rows = {}
    for i, t in tokens.items():
        rows[i] = (len(t), sum(w in c for w in t), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), sum(math.log10(p2(p, w)) for p, w in zip(["<s>", *t], t)))
    return rows, c, p2, after, unknown


def test_ids_of_any_width():
    for top in (5, (1 << 32) - 1, 1 << 32, 1 << 50):
        x = np.array([0, 3, top])
        assert katz._unpack_ints(katz._pack_ints(x)).tolist() == x.tolist()
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 50, 500), rng.integers(0, 50, 500)
    for lift in (0, 1 << 40):
        for bits in (3, 32):
            h, w, first, index = katz.distinct_pairs(a + lift, b + lift, bits)
            pairs = sorted(set(zip((a + lift).tolist(), (b + lift).tolist(), strict=True)))
            assert list(zip(h.tolist(), w.tolist(), strict=True)) == pairs
            assert (h[index] == a + lift).all() and (w[index] == b + lift).all() and (a[first] + lift == h).all()


@pytest.mark.parametrize("small", [False, True])
def test_scores_equal_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(katz, "PAIR_BITS", 4)
        monkeypatch.setattr(katz, "BLOCK_BYTES", 2000)
        monkeypatch.setattr(katz, "BUCKET_BYTES", 3000)
    rng = np.random.default_rng(8)
    words = np.array([f"w{i}" for i in range(400)])
    docs = [(i, " ".join(words[np.minimum(rng.zipf(1.4, rng.integers(1, 60)) - 1, 399)])) for i in range(200)] + [(900, None), (901, ""), (902, " \n "), (903, "NEVER seen Words é")]
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, score int").repartition(3)
    expected, c, p2, after, unknown = brute(docs, lambda i: i % 5 != 1 and i < 900)
    got = {r.doc_id: r for r in katz.score(df, (F.col("doc_id") % 5 != 1) & (F.col("doc_id") < 900)).collect()}
    assert len(got) == len(docs)
    for i, e in expected.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == e[:3]
        assert r.base_score == pytest.approx(e[3], rel=1e-9) and r.score == pytest.approx(e[4], rel=1e-9)
    for p in list(after)[:40]:
        # the probabilities after any history sum to 1
        assert sum(p2(p, w) for w in c) + p2(p, "never") == pytest.approx(1, abs=1e-9)


def test_where_good_turing_gives_no_discount():
    """Katz's formula leaves (0, 1) where a count of counts is missing or the counts do not fall; there half a count is taken off."""
    steady = np.array([0, 1000, 400, 220, 140, 100, 75.0])
    common = 6 * 75 / 1000
    assert katz.discounts(steady)[1:6] == pytest.approx([((r + 1) * steady[r + 1] / (r * steady[r]) - common) / (1 - common) for r in range(1, 6)])
    gap = np.array([0, 1000, 400, 0, 140, 100, 75.0])
    assert katz.discounts(gap)[2] == 1 - 0.5 / 2 and katz.discounts(gap)[3] == 1 - 0.5 / 3
    rising = np.array([0, 10, 40, 90, 0, 0, 0.0])
    assert katz.discounts(rising)[1] == 0.5 and katz.discounts(np.zeros(7))[1:6].tolist() == [1 - 0.5 / r for r in range(1, 6)]


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a"), (2, None)], "doc_id long, text string")
    rows = katz.score(df, F.lit(False)).collect()
    assert len(rows) == 4 and all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0 for r in rows)
    assert katz.score(df.where("doc_id > 5"), F.lit(True)).count() == 0
    trained = katz.score(df, F.lit(True)).collect()
    assert len(trained) == 4 and all(r.score < 0 for r in trained)
