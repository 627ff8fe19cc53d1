"""Corpus pipeline over documents: language, quality, near-duplicates, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows of docs; all but the last return the columns
of documents.  run() writes each stage's rows as Parquet to the folder of spark.checkpoint.dir and reads
them again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioflow.llm import stages

STAGES = [
    ("language", stages.language),
    ("quality", stages.quality),
    ("near_duplicates", stages.near_duplicates),
    ("pack", stages.pack),
]

#: SQL cannot express the trained stages; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stages.reread(spark, stage(spark, docs, sf_dir), name)
    return docs
