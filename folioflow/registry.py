"""Registry of queries: each is a function of (spark, sf_dir), with DuckDB SQL for the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its own name."""

    def add(f: Query) -> Query:
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} exists")
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = sql
        return f

    return add


def read_texts(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """A table for work that is heavy for each row: dealt out anew if its files have fewer splits than there are cores.

    Large tables have enough splits and are read as they are, without a shuffle."""
    df, cores = read(spark, sf_dir, table), spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
