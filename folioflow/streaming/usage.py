"""Structured Streaming forms of the usage queries; each has a batch twin among the plans."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def events(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """The event files of a folder as a stream, ts as an instant."""
    schema = spark.read.parquet(path).schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def hourly(stream: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Calls and values by hour and type; events later than the watermark are left out."""
    w = F.window("ts", "1 hour").alias("w")
    return stream.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select("w.start", "event_type", "n", "total")


def trailing(stream: DataFrame, span: str = "5 hours", step: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Usage of the last hours by caller, step by step."""
    w = F.window("ts", span, step).alias("w")
    return stream.withWatermark("ts", late).groupBy(w, "user_id").agg(F.count(F.lit(1)).alias("calls"), F.sum("value").alias("total")).select("w.end", "user_id", "calls", "total")


def sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of callers."""
    return stream.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select("user_id", "w.start", "w.end", "n")


def deduplicated(stream: DataFrame, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """The first of rows with the same keys within the watermark."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


class HierarchyProcessor(StatefulProcessor):
    """The stack of open groups of each document; closed groups come out as rows."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stack = handle.getListState("stack", "kind string, number long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timer_values: Any) -> Iterator[pd.DataFrame]:
        from folioflow.operators.spans import hierarchy

        level = {"CHAPTER": 0, "SECTION": 1, "STIM": 2, "Q": 3}
        before = [(f"{k}_START", int(n)) for k, n in (self.stack.get() if self.stack.exists() else [])]
        new = [(e, int(n)) for r in rows for e, n in zip(r["event"], r["number"], strict=True)]
        # what is open after these rows: replay, without the groups that only the end of input closes
        open_groups: list[tuple[str, int]] = []
        for name, number in [*before, *new]:
            kind, _, what = name.rpartition("_")
            if what == "START":
                while open_groups and level[open_groups[-1][0]] >= level[kind]:
                    open_groups.pop()
                open_groups.append((kind, number))
            elif (kind, number) in open_groups:
                while open_groups.pop() != (kind, number):
                    pass
        found = hierarchy([*before, *new])
        done = found[: len(found) - len(open_groups)]
        self.stack.clear()
        for group in open_groups:
            self.stack.appendValue(group)
        yield pd.DataFrame({"doc": [key[0]] * len(done), "kind": [x[0] for x in done], "number": [x[1] for x in done], "status": [x[2] for x in done]})

    def close(self) -> None:
        pass


def hierarchy_stream(stream: DataFrame, doc: str) -> DataFrame:
    """Closed groups of the events (event, number) of each document, as they close."""
    return stream.groupBy(doc).transformWithStateInPandas(HierarchyProcessor(), "doc long, kind string, number long, status string", "Append", "None")
