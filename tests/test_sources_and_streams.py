"""Readers, writers and streams on small files."""

import json

from pyspark.sql import functions as F

from folioflow.sources import readers, writers
from folioflow.streaming import usage


def test_pages(spark, tmp_path):
    (tmp_path / "d.md").write_text('\ufeffintro\r\n<pages><page>one<page_metadata>{"p": 2, "head": "OPEN"}</page_metadata></page><page>two<page_metadata>{"p": 5, "tail": "OPEN", oops</page_metadata></page></pages>')
    (tmp_path / "e.md").write_text("no pages")
    rows = readers.split_pages(readers.markdown(spark, str(tmp_path))).orderBy("doc_id", "p").collect()
    assert [(r.doc_id, r.p, r.page_text, r.head, r.tail) for r in rows] == [("d", 2, "intro\none", "OPEN", "CLEAN"), ("d", 5, "two", "CLEAN", "OPEN"), ("e", 1, "no pages", "CLEAN", "CLEAN")]
    again = writers.render_pages(readers.split_pages(readers.markdown(spark, str(tmp_path))))
    assert "<page>\ntwo\n<page_metadata>" in again.where("doc_id = 'd'").first().markdown


def test_usage_log_skips_broken_lines(spark, tmp_path):
    (tmp_path / "u.jsonl").write_text(json.dumps({"timestamp": "2024-01-01T00:00:00Z", "input_tokens": 3, "output_tokens": 4}) + "\n{broken\n")
    rows = readers.usage_log(spark, str(tmp_path)).collect()
    assert [(r.total_tokens, str(r.ts)) for r in rows] == [(7, "2024-01-01 00:00:00")]


def test_modules_and_curriculum(spark, tmp_path):
    docs = spark.createDataFrame([("<!-- MODULE: m1 table maths -->a<br>b<b>c</b>\n\n\n\nd<!-- /MODULE -->",)], "raw_text string")
    assert [tuple(r) for r in readers.hard_negative_modules(docs).collect()] == [("m1", "table", "maths", "a\nbc\n\nd")]
    (tmp_path / "c.json").write_text(json.dumps({"subject": "s", "chapters": [{"title": "c", "units": [{"title": "u", "problem_types": ["p", "q"]}]}]}))
    assert readers.curriculum(spark, str(tmp_path)).count() == 2


def test_dataset_split_keeps_twins_together(spark, tmp_path):
    df = spark.range(200).select(F.explode(F.array(F.col("id").cast("string"), F.concat("id", F.lit("_aug")), F.concat("id", F.lit("::chunk_1")))).alias("doc_id"))
    writers.dataset(df, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).groupBy(F.regexp_replace("doc_id", "(_aug|::.*)$", "").alias("b")).agg(F.countDistinct("split").alias("n"))
    assert back.where("n > 1").count() == 0 and spark.read.parquet(str(tmp_path / "out")).select("split").distinct().count() == 2


def _run(spark, df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    q.stop()
    return spark.table(name)


def test_hourly_stream_equals_batch(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.parquet(str(tmp_path / "e"))
    got = _run(spark, usage.hourly(usage.events(spark, str(tmp_path / "e"))), "hourly_out", "complete")
    from folioflow import catalog

    batch = catalog.queries()["hourly_tumbling"](spark, "/root/testdata/sf0.001")
    assert got.count() == batch.count() and got.agg(F.sum("n")).first()[0] == batch.agg(F.sum("n")).first()[0]


def test_hierarchy_stream(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema = "doc long, event string, number long"
    spark.createDataFrame([(1, "SECTION_START", 1), (1, "Q_START", 1)], schema).coalesce(1).write.parquet(str(tmp_path / "h"))
    spark.createDataFrame([(1, "Q_END", 1), (1, "SECTION_END", 1)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "h"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "h"))
    got = _run(spark, usage.hierarchy_stream(stream, "doc"), "hierarchy_out", "append")
    assert {tuple(r) for r in got.collect()} >= {(1, "SECTION", 1, "CLOSED")}
