"""Token windows and anchors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def window_count(n: Column, size: int, stride: int) -> Column:
    """Windows that n tokens need."""
    return F.when(n <= size, 1).otherwise(1 + F.ceil((n - size) / stride)).cast("long")


def sliding_windows(df: DataFrame, n_col: str, size: int, stride: int) -> DataFrame:
    """df with a row per window: window_id, start_token, end_token; the first window that reaches the end is the last."""
    n, k = F.col(n_col), F.col("window_id")
    last = F.greatest(F.ceil((n - size) / stride), F.lit(0)).cast("long")
    rows = df.where(n > 0).withColumn("window_id", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return rows.withColumn("start_token", k * stride).withColumn("end_token", F.least(k * stride + size, n))


def multi_scale_windows(df: DataFrame, id_col: str, n_col: str, scales: list[tuple[int, int]]) -> DataFrame:
    """Windows of several (size, stride) scales in one pass, numbered through by document as chunk_idx.

    The scales are a literal array, so nothing is joined; only the numbering needs the document's windows together."""
    n = F.col(n_col)
    scale = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(size).cast("long").alias("size"), F.lit(stride).cast("long").alias("stride")) for i, (size, stride) in enumerate(scales)])
    rows = df.where(n > 0).withColumn("s", F.explode(scale))
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil((n - F.col("s.size")) / F.col("s.stride")), F.lit(0)).cast("long"))))
    number = F.row_number().over(Window.partitionBy(id_col).orderBy("s.i", "k")) - 1
    start = F.col("k") * F.col("s.stride")
    return rows.select(id_col, n_col, F.col("s.size").alias("window_size"), number.cast("long").alias("chunk_idx"), start.alias("start_token"), F.least(start + F.col("s.size"), n).alias("end_token"))


def anchors(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, place: items (item_id, b, head) whose first words (head) stand in a document, within its words too."""
    inside = containing(docs, items, "head").where(F.expr("instr(text, head) > 0"))
    by_start = F.expr("nullif(instr(text, substring(b, 1, 30)), 0)")
    return inside.select("doc_id", "item_id", F.coalesce(by_start, F.expr("instr(text, head)")).cast("long").alias("place"))


def containing(docs: DataFrame, items: DataFrame, needle: str) -> DataFrame:
    """Pairs of docs (doc_id, text) and items in whose text the item's needle may stand; the caller's filter decides.

    What lies between the first and the last blank of a needle stands between the same blanks in every text that holds it, whereas its first and
    last words may be parts of longer ones.  So pairs meet on two such inner words (the longest two that follow each other) or on
    the only one; needles without any are looked for in every text.  Inner words travel with ids only, each pair of ids once; the texts
    join the pairs that are left."""
    words = lambda c: F.split(c, " ")
    twos = lambda w: F.zip_with(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, F.lit(2), F.size(w)), lambda a, b: F.concat(a, F.lit(" "), b))
    n = F.size(words(needle))
    inner = F.slice(words(needle), F.lit(2), F.greatest(n - 2, F.lit(0)))
    longest = F.array_max(F.transform(twos(inner), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    ids = lambda key, of_doc, of_item: docs.select("doc_id", F.explode(F.array_distinct(of_doc)).alias("_w")).join(items.where(key).select("item_id", of_item.alias("_w")), "_w").select("doc_id", "item_id")
    short = docs.join(items.where(n < 3).select("item_id", F.col(needle).alias("_w")), F.contains("text", "_w")).select("doc_id", "item_id")
    pairs = ids(n > 3, twos(words("text")), longest).unionAll(ids(n == 3, words("text"), F.get(inner, F.lit(0)))).unionAll(short)
    pairs = pairs.distinct().toDF("_d", "_i")
    found = pairs.join(docs, F.col("_d").eqNullSafe(F.col("doc_id"))).join(items, F.col("_i").eqNullSafe(F.col("item_id")))
    return found.drop("_d", "_i")
