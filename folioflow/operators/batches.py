"""Next-fit batches over whole groups of any size: chunks of rows in order, joined by what each does to the batch that comes into it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a chunk; the batches do not depend on it.
CHUNK = 4096


def _written(df: DataFrame, name: str) -> DataFrame:
    """df, written to the folder of spark.checkpoint.dir and read again; where that is unset (tests), to a new local one."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or "file://" + tempfile.mkdtemp(prefix="shared-")
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def jumps(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums, and for each row, taken as the start of a batch, the start of the next one (the number of rows: beyond them)."""
    sums = np.cumsum(sizes)
    return sums, np.maximum(np.searchsorted(sums, sums - sizes + room, side="right"), np.arange(1, len(sizes) + 1))


def entries(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row where the first batch of a chunk can begin: the prefix sum up to it, the batches that begin from there on, and the size of the last one."""
    sums, after = jumps(sizes, room)
    n, most = len(sizes), min(int(np.searchsorted(sums, room, side="right")) + 1, len(sizes))
    count, last = np.ones(n, dtype=np.int64), sums[-1] - sums + sizes
    for i in range(n - 1, -1, -1):
        if after[i] < n:
            count[i], last[i] = count[after[i]] + 1, last[after[i]]
    return sums[:most], count[:most], last[:most]


def next_fit(df: DataFrame, group: str, order: str, size: Column, budget: int, overhead: int) -> DataFrame:
    """group, batch, first (the lowest order), docs and tokens (with the overhead) of next-fit batches over each whole group in order.

    Rows are sorted by range, so that a large group is many chunks.  A chunk tells for each row at which its first batch can
    begin what follows; one short row for each chunk is then read in order, with a state of two numbers, to find the batch
    that comes into it, and all chunks are cut at once.  Larger rows than the budget stand alone; null sizes count as 0, null
    orders as -1."""
    room = budget - overhead
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = df.select(key.alias("k"), F.coalesce(F.col(order).cast("long"), F.lit(-1).cast("long")).alias("o"), F.coalesce(size.cast("long"), F.lit(0).cast("long")).alias("w"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, held, orders, sizes = TaskContext.get().partitionId(), 0, None, np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

        def chunk() -> pd.DataFrame:
            sums, count, last = entries(sizes[:CHUNK], room)
            return pd.DataFrame({"k": [held], "part": [part], "number": [number], "o": [orders[:CHUNK]], "w": [sizes[:CHUNK]], "sums": [sums], "count": [count], "last": [last], "total": [int(sizes[:CHUNK].sum())]})

        for batch in batches:
            if batch.empty:
                continue
            keys, o, w = batch["k"].to_numpy(), batch["o"].to_numpy(dtype=np.int64), batch["w"].to_numpy(dtype=np.int64)
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if keys[a] != held:
                    if len(sizes):
                        yield chunk()
                        number += 1
                    held, orders, sizes = keys[a], o[a:b], w[a:b]
                else:
                    orders, sizes = np.concatenate([orders, o[a:b]]), np.concatenate([sizes, w[a:b]])
                while len(sizes) >= CHUNK:
                    yield chunk()
                    number, orders, sizes = number + 1, orders[CHUNK:], sizes[CHUNK:]
        if len(sizes):
            yield chunk()

    def carry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, at, used = None, -1, -1
        for batch in batches:
            out = []
            for k, part, number, sums, count, last, total in zip(*(batch[c] for c in ("k", "part", "number", "sums", "count", "last", "total")), strict=True):
                if k != held:
                    held, at, used = k, -1, -1
                out.append((part, number, at, used))
                p = 0 if used < 0 else int(np.searchsorted(sums, room - used, side="right"))
                at, used = (at + int(count[p]), int(last[p])) if p < len(sums) else (at, used + total)
            yield pd.DataFrame(out, columns=["part", "number", "at", "used"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, o, w, at, used in zip(*(batch[c] for c in ("k", "o", "w", "at", "used")), strict=True):
                sums, after = jumps(np.asarray(w), room)
                starts, i = [0], 0 if used < 0 else int(np.searchsorted(sums, room - used, side="right"))
                first = at + (i == 0)  # the open batch may take rows, or none
                while i < len(sums):
                    if i:
                        starts.append(i)
                    i = int(after[i])
                ends = np.array([*starts[1:], len(sums)])
                yield pd.DataFrame({"k": k, "batch": first + np.arange(len(starts)), "first": np.asarray(o)[starts], "docs": ends - starts, "tokens": np.diff(sums[ends - 1], prepend=0)})

    longs = "array<long>"
    packed = rows.repartitionByRange("k", "o", "w").sortWithinPartitions("k", "o", "w").mapInPandas(pack, f"k string, part int, number int, o {longs}, w {longs}, sums {longs}, count {longs}, last {longs}, total long")
    chunks = _written(packed, "batch-chunks")
    carried = chunks.drop("o", "w").repartition("k").sortWithinPartitions("k", "part", "number").mapInPandas(carry, "part int, number int, at long, used long")
    parts = chunks.select("k", "part", "number", "o", "w").join(carried, ["part", "number"]).mapInPandas(cut, "k string, batch long, first long, docs long, tokens long")
    out = parts.groupBy("k", "batch").agg(F.min("first").alias("first"), F.sum("docs").alias("docs"), (F.sum("tokens") + overhead).alias("tokens"))
    return out.select(F.when(F.col("k") != "", F.substring("k", 2, 1 << 30)).cast(df.schema[group].dataType).alias(group), "batch", "first", "docs", "tokens")
