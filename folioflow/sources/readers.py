"""Readers of documents, logs, modules and curricula.  All use Spark's own file sources, so any of its stores will do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.functions import text as X

#: Reads past broken fields and lines.
USAGE = "timestamp string, provider string, model string, caller string, input_tokens long, cache_read_tokens long, reasoning_tokens long, output_tokens long, total_tokens long, duration_sec double"


def markdown(spark: SparkSession, path: str) -> DataFrame:
    """doc_id (name of a folder doc_id=..., else of the file without extension) and raw_text of each file (SRC-1)."""
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    folder = F.regexp_extract("_metadata.file_path", "/doc_id=([^/]+)/", 1)
    return files.select(F.when(folder != "", folder).otherwise(F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")).alias("doc_id"), F.col("value").alias("raw_text"))


def split_pages(docs: DataFrame, doc: str = "doc_id", text: str = "raw_text") -> DataFrame:
    """doc, p, page_text, meta (JSON text), head, tail, words, is_blank: pages of marked-up documents (SRC-2, SRC-4).

    Carriage returns and byte-order marks go, unclosed pages end at the next one, repeated openers count once, text before
    the first page belongs to it, and a document without pages is one page.  Broken metadata is read by pattern."""
    clean = F.regexp_replace(F.regexp_replace(F.col(text), "^\ufeff", ""), "\r\n?", "\n")
    clean = F.regexp_replace(F.regexp_replace(clean, r"(?i)</?pages\s*>", ""), r"(?i)(<page(?:\s[^>]*)?>\s*)+", "<page>")
    parts = F.split(F.regexp_replace(clean, r"(?i)</page\s*>", ""), "<page>")
    # text before the first page
    lead = F.element_at(parts, 1)
    pages = F.when(F.size(parts) == 1, parts).otherwise(F.concat(F.array(F.concat(lead, F.element_at(parts, 2))), F.slice(parts, F.lit(3), F.greatest(F.size(parts) - 2, F.lit(0)))))
    rows = docs.select(doc, F.posexplode(pages).alias("i", "raw"))
    meta = F.regexp_extract("raw", r"(?is)<page_metadata>(.*?)(?:</page_metadata>|$)", 1)
    body = X.strip_blank(F.regexp_replace(F.regexp_replace("raw", r"(?is)<page_metadata>.*?(?:</page_metadata>|$)", ""), r"(?s)<!--\s*page_metadata.*?-->", ""))

    def field(name: str, pattern: str) -> Column:
        found = F.regexp_extract(meta, rf'"{name}"\s*:\s*{pattern}', 1)
        return F.coalesce(F.get_json_object(meta, f"$.{name}"), F.when(found != "", found))

    number = field("p", r"(\d+)").try_cast("int")
    words = F.size(X.split_words(body))
    out = rows.select(doc, "i", number.alias("given"), body.alias("page_text"), meta.alias("meta"), F.coalesce(field("head", '"([A-Z_]+)"'), F.lit("CLEAN")).alias("head"), F.coalesce(field("tail", '"([A-Z_]+)"'), F.lit("CLEAN")).alias("tail"), F.when(words == 0, 0).otherwise(F.greatest(words, F.lit(50))).alias("estimated_tokens"), (words == 0).alias("is_blank"))
    # given numbers count if they rise strictly
    w = Window.partitionBy(doc).orderBy("i")
    good = F.col("given").isNotNull() & (F.lag("given").over(w).isNull() | (F.col("given") > F.lag("given").over(w)))
    every = F.min("good").over(Window.partitionBy(doc))
    return out.withColumn("good", good).withColumn("p", F.when(every, F.col("given")).otherwise(F.col("i") + 1)).drop("good", "given", "i")


def usage_log(spark: SparkSession, path: str) -> DataFrame:
    """Usage records of JSON lines; broken lines are skipped, totals default to the sum of their parts (SRC-8, SNK-6)."""
    rows = spark.read.schema(USAGE).option("mode", "DROPMALFORMED").json(path)
    part = lambda c: F.coalesce(F.col(c), F.lit(0))
    total = F.coalesce("total_tokens", part("input_tokens") + part("output_tokens") + part("reasoning_tokens"))
    return rows.withColumn("total_tokens", total).withColumn("ts", F.try_to_timestamp("timestamp"))


def hard_negative_modules(docs: DataFrame, text: str = "raw_text") -> DataFrame:
    """module_id, module_type, subject, body of the blocks <!-- MODULE: id type subject --> ... <!-- /MODULE --> (SRC-10, SRC-11)."""
    pattern = r"(?s)<!--\s*MODULE:\s*(\S+)\s+(\S+)\s+(\S+)\s*-->(.*?)<!--\s*/MODULE\s*-->"
    columns = [F.regexp_extract_all(text, F.lit(pattern), F.lit(i)) for i in range(1, 5)]
    rows = docs.select(F.explode(F.arrays_zip(*[c.alias(n) for c, n in zip(columns, ("module_id", "module_type", "subject", "raw"), strict=True)])).alias("m")).select("m.*")
    body = F.regexp_replace(F.regexp_replace(F.col("raw"), r"(?s)<!--.*?-->", ""), r"(?i)<br\s*/?>", "\n")
    return rows.select("module_id", "module_type", "subject", X.strip_blank(X.squeeze_lines(F.regexp_replace(body, r"</?[A-Za-z][^>]*>", ""))).alias("body"))


def curriculum(spark: SparkSession, path: str) -> DataFrame:
    """subject, chapter, unit, problem_type of nested curriculum files (SRC-12, GEN-16)."""
    tree = "subject string, chapters array<struct<title:string,units:array<struct<title:string,problem_types:array<string>>>>>"
    rows = spark.read.schema(tree).option("multiLine", True).json(path)
    rows = rows.select("subject", F.explode("chapters").alias("c")).select("subject", F.col("c.title").alias("chapter"), F.explode("c.units").alias("u"))
    return rows.select("subject", "chapter", F.col("u.title").alias("unit"), F.explode("u.problem_types").alias("problem_type"))
