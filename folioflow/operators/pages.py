"""Pages of documents: offsets, renumbering, sampling, chunks and chunk plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def page_offsets(df: DataFrame, doc: str, page: str, text: str, gap: int = 2) -> DataFrame:
    """df with global_start and global_end of each page in the document of all pages, with gap characters between them."""
    before = Window.partitionBy(doc).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length(text) + gap).over(before), F.lit(0)).cast("long")
    return df.withColumn("global_start", start).withColumn("global_end", F.col("global_start") + F.length(text))


def renumber(df: DataFrame, doc: str, order: str, number: str) -> DataFrame:
    """df with page_no: the given numbers where they rise strictly in the document, else 1 to n."""
    w = Window.partitionBy(doc).orderBy(order)
    rises = F.coalesce(F.col(number) > F.lag(number).over(w), F.lit(True))
    numbered = df.withColumn("_rises", rises).withColumn("_at", F.row_number().over(w))
    every = F.min("_rises").over(Window.partitionBy(doc))
    return numbered.withColumn("page_no", F.when(every, F.col(number)).otherwise(F.col("_at")).cast("long")).drop("_rises", "_at")


def sample_pages(df: DataFrame, doc: str, page: str) -> DataFrame:
    """All pages of documents of up to three; else the first, the middle one and the next."""
    n, at = F.count(F.lit(1)).over(Window.partitionBy(doc)), F.row_number().over(Window.partitionBy(doc).orderBy(page))
    rows = df.withColumn("_n", n).withColumn("_at", at)
    mid = F.floor(F.col("_n") / 2) + 1
    return rows.where((F.col("_n") <= 3) | (F.col("_at") == 1) | (F.col("_at") == mid) | (F.col("_at") == mid + 1)).drop("_n", "_at")


def greedy_chunks(sizes: Column, target: int) -> Column:
    """Chunk number of each element of an array of sizes: a chunk ends once its total reaches the target.

    The fold's state is one struct, so it runs in generated code; only one document's sizes are held."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("chunk"), F.array().cast("array<long>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        total = s["total"] + x
        full = total >= target
        return F.struct(F.when(full, F.lit(0)).otherwise(total).cast("long").alias("total"), (s["chunk"] + full.cast("long")).alias("chunk"), F.concat(s["out"], F.array(s["chunk"])).alias("out"))

    return F.aggregate(sizes, start, step, lambda s: s["out"])


def next_fit(sizes: Column, budget: int, overhead: int) -> Column:
    """Batch number of each element: a new batch begins where an element would exceed the budget; larger ones stand alone."""
    start = F.struct(F.lit(overhead).cast("long").alias("total"), F.lit(0).cast("long").alias("batch"), F.lit(False).alias("any"), F.array().cast("array<long>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        cut = s["any"] & (s["total"] + x > budget)
        batch = s["batch"] + cut.cast("long")
        return F.struct(F.when(cut, overhead + x).otherwise(s["total"] + x).cast("long").alias("total"), batch.alias("batch"), F.lit(True).alias("any"), F.concat(s["out"], F.array(batch)).alias("out"))

    return F.aggregate(sizes, start, step, lambda s: s["out"])
