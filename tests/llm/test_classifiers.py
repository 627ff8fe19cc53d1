"""Language, toxicity and quality classifiers: accuracy on what they did not see, and defined results of odd inputs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioflow.llm import _text as T
from folioflow.llm import language_id, quality, toxicity

DATA = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "  \n"), (4, "12 34 !!"), (5, "word"), (5, "word"), (6, "x" * 300_000), (7, "the and of " * 20_000), (None, "the")]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame([(i, t, "mine", 1.0, 7) for i, t in ODD], "doc_id long, text string, lang_pred string, score double, extra int")


def test_language_accuracy_and_held_out(spark):
    out = language_id.query(spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = out.where("held_out")
    assert held.where("lang = lang_pred").count() / held.count() > 0.97
    assert out.where("score < 0 or score > 1").count() == 0 and out.count() == 1000


def test_language_of_odd_texts(spark, odd):
    model = language_id.train(spark.read.parquet(f"{DATA}/documents.parquet"))
    out = language_id.predict(odd, model)
    assert set(out.columns) == {"doc_id", "text", "extra", "lang_pred", "score", "rejected", "distance"}
    got = {(r.doc_id, (r.text or "")[:5]): (r.lang_pred, r.score, r.rejected) for r in out.collect()}
    for key in ((1, ""), (2, ""), (3, "  \n"), (4, "12 34")):
        assert got[key] == ("und", 0.0, True)
    assert got[5, "word"][0] != "und" and out.count() == len(ODD)
    assert language_id.train(odd.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r.lang_pred for r in language_id.predict(odd, None).collect()} == {"und"}
    assert language_id.predict(odd.where("doc_id < 0"), model).count() == 0


def test_language_letters_of_other_scripts(spark):
    model = language_id.train(spark.read.parquet(f"{DATA}/documents.parquet"))
    rows = spark.createDataFrame([(1, "日本語"), (2, "１２３ – €"), (3, "ñ")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in language_id.predict(rows, model).collect()}
    assert got[1] != "und" and got[2] == "und" and got[3] != "und"


def test_quality_accuracy(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "quality")
    out = quality.query(spark, DATA).join(labels, "doc_id")
    assert out.where("predicted = quality").count() / out.count() > 0.93
    held = out.where("held_out")
    assert held.where("predicted = quality").count() / held.count() > 0.85


def test_quality_odd_inputs(spark, odd):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    model = quality.train(docs, labels.unionByName(labels.limit(5)).unionByName(spark.createDataFrame([(None, 1, None), (1, None, 1)], labels.schema)))
    rows = quality.predict(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) <= 2
    alone = quality.train(docs.where("doc_id < 0"), labels.where("doc_id < 0"))
    assert {r.score for r in quality.predict(odd, alone).collect()} == {0.5}
    assert quality.train(docs, labels.where("quality = 1")).share == 1.0


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    z = rng.normal(size=20_000) * 2
    y = (rng.random(20_000) < 1 / (1 + np.exp(-z))).astype(float)
    assert abs(quality.temperature(3 * z, y) - 3) < 0.3


def test_toxicity_accuracy(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    out = toxicity.query(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out")
    tp, fp, fn = (out.where(c).count() for c in ("predicted = 1 and toxic = 1", "predicted = 1 and toxic = 0", "predicted = 0 and toxic = 1"))
    assert tp / (tp + fn) > 0.8 and tp / (tp + fp) > 0.85


def test_toxicity_odd_inputs(spark, odd):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    rows = toxicity.predict(odd, toxicity.train(docs, labels)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score < toxicity.THRESHOLD for r in rows if r.doc_id in (1, 2, 3, 4))
    none = toxicity.train(docs, labels.where("toxic = 0"))
    assert all(r.score < 1e-6 for r in toxicity.predict(odd, none).collect())
    assert toxicity.train(docs.where("doc_id < 0"), labels).keys.size == 0


def test_nnpu_learns_from_positives_and_unlabelled():
    rng = np.random.default_rng(2)
    def rows(n, positive):
        x = [rng.choice(np.arange(0, 5) if p else np.arange(5, 40), 3, replace=False) for p in positive]
        return np.repeat(np.arange(n), 3), np.concatenate(x), n
    hidden = rng.random(2000) < 0.2
    unlabelled = rows(2000, hidden)
    w, b = toxicity.fit_nnpu(rows(300, np.ones(300, bool)), unlabelled, 40, 0.2)
    f = b + np.bincount(unlabelled[0], w[unlabelled[1]], minlength=2000)
    assert ((f > 0) == hidden).mean() > 0.97


def test_words_and_hashes_match_plain_python():
    texts = ["Ab  cd\tEF", None, "", "x", "é ü", "a" * 70 + " b"]
    for inside, pattern in ((T.SPACED, r"[^\x20\x09-\x0D]+"), (T.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        import re

        seen = {}
        for part in T.parts(pa.array(texts), max_bytes=16):
            data = T.LOWER[part.data]
            words = T.find_words(data, part.offsets, inside)
            plain = [re.findall(pattern, (t or "").translate({c: c + 32 for c in range(65, 91)})) for t in texts[part.lo : part.hi]]
            assert words.counts.tolist() == [len(p) for p in plain]
            for w, h in zip([w for p in plain for w in p], T.hash_words(data, words, inside).tolist(), strict=True):
                assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def test_sliced_and_large_columns():
    column = pa.array(["ab", "cd ef", None, "g"], pa.large_string()).slice(1)
    counts = [c for part in T.parts(column, max_rows=2) for c in T.find_words(part.data, part.offsets, T.SPACED).counts.tolist()]
    assert counts == [2, 0, 1]
