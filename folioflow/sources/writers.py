"""Sinks: datasets by split, ledgers, quarantine, rendered pages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.operators.relational import upsert


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir, which driver and executors share; in the local temp folder where a local session has none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="scratch-")
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def text_files(df: DataFrame, path: str) -> None:
    """One text file for each row of df (doc_id, text), in a folder doc_id=...; each ends with a line break.

    What a file costs is its making, whatever its size, so rows are dealt to several tasks for each core, not to as few as their bytes
    fill; tasks move their own files to their place (algorithm 2), which the driver would else do one by one."""
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    rows = df.toDF("doc_id", "text").repartition(tasks, "doc_id")
    rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("doc_id").text(path)


def dataset(df: DataFrame, path: str, *, id_col: str = "doc_id", dev_ratio: float = 0.1, kind: str = "parquet") -> None:
    """Write df by split, train or dev; parts and augmented twins of a document go with it (SNK-1)."""
    split = F.when(X.is_dev(id_col, dev_ratio), "dev").otherwise("train")
    df.withColumn("split", split).write.mode("overwrite").partitionBy("split").format(kind).save(path)


def quarantine(df: DataFrame, path: str, decision: str = "decision") -> None:
    """Write df by decision, so that discarded rows lie apart (SNK-7)."""
    df.write.mode("overwrite").partitionBy(decision).parquet(path)


def ledger(base: DataFrame, changes: DataFrame, key: str, values: list[str], path: str) -> None:
    """A new version of a keyed table with changes applied; versions do not overwrite what they read (SNK-5)."""
    upsert(base, changes, key, values).write.mode("errorifexists").parquet(path)


def render_pages(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """doc and markdown: pages (p, page_text, head, tail) in order with their metadata as JSON (SNK-3)."""
    meta = F.to_json(F.struct("p", "head", "tail"))
    block = F.concat(F.lit("<page>\n"), "page_text", F.lit("\n<page_metadata>"), meta, F.lit("</page_metadata>\n</page>"))
    rows = F.array_sort(F.collect_list(F.struct("p", block.alias("b"))))
    return pages.groupBy(doc).agg(F.concat(F.lit("<pages>\n"), F.array_join(F.transform(rows, lambda r: r["b"]), "\n"), F.lit("\n</pages>\n")).alias("markdown"))
