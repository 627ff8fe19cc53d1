"""Next-fit batches run over whole groups, whatever the ids and the chunks are."""

import random

import pytest
from pyspark.sql import functions as F

from folioflow import catalog
from folioflow.operators import batches as B


def by_hand(rows, budget, overhead):
    """Batches (group, batch, first, docs, tokens) by a plain walk."""
    out, open_batch = [], {}
    for group, order, size in sorted(rows, key=lambda r: ("" if r[0] is None else "=" + r[0], r[1], r[2])):
        now = open_batch.get(group)
        if now is None or now[4] + size > budget:
            now = open_batch[group] = [group, 0 if now is None else now[1] + 1, order, 0, overhead]
            out.append(now)
        now[3] += 1
        now[4] += size
    return sorted((tuple(x) for x in out), key=str)


@pytest.mark.parametrize("chunk", [1, 3, 50])
def test_next_fit_equals_a_plain_walk(spark, monkeypatch, chunk):
    rng = random.Random(chunk)
    rows = [(rng.choice(["a", "a", "a", "b", "", None]), i * 977, rng.choice([0, 0, 1, 3, 8, 20, 90, 91, 200])) for i in range(600)]
    monkeypatch.setattr(B, "CHUNK", chunk)
    got = B.next_fit(spark.createDataFrame(rows, "g string, o long, w long"), "g", "o", F.col("w"), 100, 10).collect()
    assert sorted((tuple(r) for r in got), key=str) == by_hand(rows, 100, 10)


def test_batch_pack_documents_goes_on_over_sparse_ids(spark, tmp_path):
    rows = [("web" if i % 7 else "mail", i * 1500, 400 + i * 37 % 9000) for i in range(300)]
    spark.createDataFrame(rows, "source string, doc_id long, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.queries()["batch_pack_documents"](spark, str(tmp_path)).collect()
    want = by_hand([(s, i, n // 4) for s, i, n in rows], 4000, 100)
    assert sorted((tuple(r) for r in got), key=str) == want
