"""Pipeline stages: their decisions take effect, columns stay, odd rows do not break them; contracts of the queries."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folioflow import llm
from folioflow.llm import language_id, minhash, quality, stages

DATA = "/root/testdata/sf0.001"

CONTRACT = {
    "op1_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op2_kmeans_tree": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op3_sentencepiece": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op4_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_lattice": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op6_minhash": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op7_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op8_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op9_licenses": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"},
    "op10_katz": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_of_each_query(spark, name):
    df = llm.queries()[name](spark, DATA)
    types = dict(df.dtypes)
    assert {c: types[c] for c in CONTRACT[name]} == CONTRACT[name]
    key = "doc_id" if "doc_id" in types else None
    if key and name != "op7_packing":
        assert df.select(key).count() == spark.read.parquet(f"{DATA}/documents.parquet").count()


def test_stages_filter_by_their_operators(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    first = stages.reread(spark, stages.language(spark, docs, DATA), "a")
    model = language_id.train(docs.where(~language_id.held_out()))
    assert first.columns == columns
    assert {r.doc_id for r in first.collect()} == {r.doc_id for r in language_id.predict(docs, model).where("not rejected").collect()}
    second = stages.reread(spark, stages.quality(spark, first, DATA), "b")
    assert second.columns == columns and 0 < second.count() <= first.count()
    third = stages.reread(spark, stages.near_duplicates(spark, second, DATA), "c")
    kept = {r.doc_id for r in minhash.near_duplicates(second, words=5).where("kept").collect()}
    assert third.columns == columns and {r.doc_id for r in third.collect()} == kept
    pieces = stages.pack(spark, third, DATA)
    assert {r.doc_id for r in pieces.collect()} == kept


def test_near_duplicate_stage_keeps_one_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(3, text, "en", None, 1), (1, text, None, "s", 1), (1, text, None, "s", 1), (2, text + " x", "en", "s", 1), (9, "a b c", "en", "s", 1), (None, text, "en", "s", 1), (8, None, "en", "s", 0), (7, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = stages.near_duplicates(spark, docs, DATA)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 1, 7, 8, 9]
    assert stages.near_duplicates(spark, docs.where("n_chars > 5"), DATA).count() == 0


def test_stages_keep_the_values_of_any_column(spark):
    """Columns named like those of the operators, or of their joins, go through as they are."""
    names = ["score", "distance", "lang_pred", "rejected", "y", "id", "n", "__row", "kept", "chosen", "text_key", "order", "c0", "row", "a.b"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    wide = docs.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in names])
    wide = wide.unionAll(wide.where("doc_id % 20 = 3"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stages.reread(spark, stage(spark, wide, DATA), name)
        assert out.columns == wide.columns
        rows = out.collect()
        assert len(rows) > 100 and all(r[c] == f"{c} {r.doc_id}" for r in rows for c in names)
        plain = stage(spark, docs.unionAll(docs.where("doc_id % 20 = 3")), DATA)
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in plain.collect())
    assert stages.pack(spark, wide, DATA).count() > 200


def test_near_duplicate_stage_takes_texts_of_one_id_apart(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(1, a, 1), (1, b, 2), (2, a, 3), (1, a, 4), (3, b + " z", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    got = sorted((r.doc_id, r.text) for r in stages.near_duplicates(spark, docs, DATA).collect())
    assert got == sorted([(1, a), (1, b)])


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "the and", "en", "s", 7), (4, "x " * 50_000, None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("mine")).withColumn("rejected", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns and out.count() <= 4
    assert stages.pack(spark, docs, DATA).count() >= 4
    empty = docs.where("n_chars > 100")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, DATA).count() == 0


def test_run_writes_to_the_shared_folder(spark):
    out = corpus_pipeline.run(spark, DATA)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "pack"]
    assert out.count() > 0 and out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    assert all(re.search("stage-pack-", f) for f in out.inputFiles())


def test_quality_threshold_is_the_contract():
    assert quality.THRESHOLD == 0.3
