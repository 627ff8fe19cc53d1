"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and lets its operator's decisions take effect."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_id, minhash, packing
from . import quality as quality_classifier
from ._shared import table


def reread(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet and read again."""
    return table(df, f"stage-{name}")


def _where(docs: DataFrame, predict: Callable[..., DataFrame], condition: Column) -> DataFrame:
    """The rows of docs whose result of predict(rows, text_col=...) meets a condition.

    The columns of docs go through under names of their own, so that none meets a column of the result."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    out = predict(docs.toDF(*names.values()), text_col=names["text"]).where(condition)
    return out.select(*[F.col(k).alias(c) for c, k in names.items()])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; rejected ones go."""
    model = language_id.train(docs.where(~language_id.held_out()))
    return _where(docs, lambda df, text_col: language_id.predict(df, model, text_col=text_col), ~F.col("rejected"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the classifier learns from the labels of the documents at hand."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").where(~quality_classifier.held_out())
    model = quality_classifier.train(docs, labels)
    return _where(docs, lambda df, text_col: quality_classifier.predict(df, model, text_col=text_col), F.col("score") >= quality_classifier.THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates by shingles of five words.

    Rows of one id with different texts are different documents.  Of rows with the same id and text one stays, the
    first in the order of a hash of all columns; rows without an id stay."""
    found = table(minhash.classes(docs, words=5).select("doc_id", "text_key", "chosen"), "chosen")
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    key = [F.col(names["doc_id"]).cast("long").alias("doc_id"), F.xxhash64(names["text"]).alias("text_key")]
    rows = docs.toDF(*names.values()).select(*key, *names.values())
    rows = rows.join(found.where("not chosen").select("doc_id", "text_key").distinct(), ["doc_id", "text_key"], "left_anti")
    repeated = found.where("chosen and doc_id is not null").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "text_key")
    repeated = table(repeated, "repeated")
    if repeated.head(1):
        whole = F.struct(*names.values())
        first = rows.join(repeated, ["doc_id", "text_key"], "left_semi").groupBy("doc_id", "text_key").agg(F.min_by(whole, F.struct(F.xxhash64(*names.values()), F.hash(*names.values()))).alias("row"))
        rows = rows.join(repeated, ["doc_id", "text_key"], "left_anti").unionByName(first.select("doc_id", "text_key", "row.*"))
    return rows.select(*[F.col(k).alias(c) for c, k in names.items()])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
