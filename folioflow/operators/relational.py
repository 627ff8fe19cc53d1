"""Join and window semantics of annotation pipelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def runs(df: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """Runs of equal values in order: by, run, value, first, last, n."""
    w = Window.partitionBy(by).orderBy(order)
    new = (F.col(value) != F.lag(value).over(w)) | F.lag(value).over(w).isNull()
    rows = df.withColumn("run", F.sum(new.cast("long")).over(w))
    return rows.groupBy(by, "run", value).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n"))


def fill_forward(df: DataFrame, by: str, order: str, value: Column, reset: Column) -> Column:
    """The last value so far, forgotten at each reset."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    # the last event of either kind decides: its value, or null at a reset
    return F.last(F.when(reset, F.struct(F.lit(None).cast("long").alias("v"))).when(value.isNotNull(), F.struct(value.cast("long").alias("v"))), ignorenulls=True).over(w)["v"]


def interval_join(points: DataFrame, spans: DataFrame, by: str, start: str, end: str, s: str, e: str, width: int) -> DataFrame:
    """Rows of points and spans of the same group that overlap (max of starts < min of ends).

    Both sides are dealt to buckets of width, so a group of many rows is not compared as a whole; a pair counts in
    the bucket where its overlap begins."""
    buckets = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / width), F.floor((F.greatest(F.col(b), F.col(a) + 1) - 1) / width)))
    p, q = points.withColumn("_b", buckets(start, end)), spans.withColumn("_b", buckets(s, e))
    both = p.join(q, [by, "_b"])
    low = F.greatest(F.col(start), F.col(s))
    return both.where((low < F.least(F.col(end), F.col(e))) & (F.floor(low / width) == F.col("_b"))).drop("_b")


def latest(df: DataFrame, keys: list[str], order: list[str], *values: str) -> DataFrame:
    """The values of the last row of each key."""
    return df.groupBy(*keys).agg(*[F.max_by(v, F.struct(*order)).alias(v) for v in values])


def upsert(base: DataFrame, changes: DataFrame, key: str, values: list[str]) -> DataFrame:
    """base with the changes' values where they have the key, and their new keys."""
    c = changes.select(key, F.lit(True).alias("_new"), *[F.col(v).alias(f"_{v}") for v in values])
    return base.join(c, key, "outer").select(key, *[F.when(F.col("_new"), F.col(f"_{v}")).otherwise(F.col(v)).alias(v) for v in values])


def multiset_cascade(left: DataFrame, right: DataFrame, keys: list[list[str]], id_col: str) -> DataFrame:
    """Match rows one to one on ever weaker keys: id, match (id of the other side), tier.  Each tier joins what earlier ones left, by rank within the key."""
    out = None
    for tier, by in enumerate(keys):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(id_col))
        a, b = left.withColumn("_r", rank), right.withColumn("_r", rank).select(*by, "_r", F.col(id_col).alias("match"))
        hit = a.join(b, [*by, "_r"]).select(id_col, "match", F.lit(tier).alias("tier"))
        out = hit if out is None else out.unionAll(hit)
        left = left.join(hit, id_col, "left_anti")
        right = right.join(hit.select(F.col("match").alias(id_col)), id_col, "left_anti")
    return out


def trailing(df: DataFrame, by: str, time: str, span: int, **sums: str) -> DataFrame:
    """df with calls (rows of the same group within span before each row, itself included) and sums of columns over them.

    A group is cut into stretches of span; each row also goes to the next stretch as context, so no task holds a whole
    group, however many rows it has."""
    at = F.floor(F.col(time) / span)
    rows = df.withColumn("_c", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("_s", at + F.col("_c"))
    w = Window.partitionBy(by, "_s").orderBy(time).rangeBetween(-span, 0)
    out = rows.withColumn("calls", F.count(F.lit(1)).over(w))
    for name, column in sums.items():
        out = out.withColumn(name, F.sum(column).over(w))
    return out.where("_c = 0").drop("_c", "_s")


def ranks(df: DataFrame, order: str, *by: str) -> DataFrame:
    """df with rank, from 0 in the order of a column (within each value of by; equal ones in any order).

    Rows are range-partitioned, so that no task holds a whole group or all rows; counts of the ranges, one row for each
    range and group, give each range its first rank."""
    cut = df.repartitionByRange(*by, order).withColumn("_range", F.spark_partition_id())
    counts = cut.groupBy("_range", *by).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_range")) - F.col("_n")
    own = F.row_number().over(Window.partitionBy("_range", *by).orderBy(order)) - 1
    first = F.broadcast(counts.withColumn("_before", before).drop("_n"))  # ranges x the groups that meet in them
    return cut.withColumn("rank", own).join(first, ["_range", *by]).withColumn("rank", F.col("rank") + F.col("_before")).drop("_range", "_before")


def count_between(points: DataFrame, probes: DataFrame, by: str, at: str, low: str, high: str, width: float) -> DataFrame:
    """probes (by, low, high) that have points (by, at) of their group between low and high, both included, with their number n.

    Pairs are not made: points and both ends of the probes are sorted within buckets of about width, and the points before
    an end are those of earlier buckets and those before it in its own.  Equal points, and equal probes, are one row each."""
    key = lambda c: (F.col(c) + F.lit(0.0)).alias("v")  # noqa: E731 - one zero
    known = points.where(F.col(by).isNotNull() & F.col(at).isNotNull()).groupBy(by, key(at)).agg(F.count(F.lit(1)).alias("w")).select(by, "v", F.lit(1).alias("kind"), "w")
    asked = probes.where(F.col(by).isNotNull()).select(by, low, high).distinct()
    ends = asked.select(by, F.explode(F.array(*[F.struct(key(c), F.lit(kind).alias("kind")) for c, kind in ((low, 0), (high, 2))])).alias("e")).select(by, "e.v", "e.kind").where("v is not null").distinct()
    rows = known.unionByName(ends.withColumn("w", F.lit(0).cast("long"))).withColumn("b", F.rint(F.col("v") / width))
    before = F.sum("w").over(Window.partitionBy(by).orderBy("b")) - F.col("w")
    earlier = rows.groupBy(by, "b").agg(F.sum("w").alias("w")).select(by, "b", before.alias("before"))
    own = F.sum("w").over(Window.partitionBy(by, "b").orderBy("v", "kind").rowsBetween(Window.unboundedPreceding, 0))
    found = rows.withColumn("own", own).where("kind <> 1").join(earlier, [by, "b"]).select(by, "v", "kind", (F.col("own") + F.col("before")).alias("n"))
    up_to = lambda kind, n: found.where(F.col("kind") == kind).select(F.col(by).alias("_by"), F.col("v").alias("_v"), F.col("n").alias(n))
    for kind, end, n in ((0, low, "n0"), (2, high, "n2")):
        asked = asked.join(up_to(kind, n), (F.col(by) == F.col("_by")) & ((F.col(end) + F.lit(0.0)) == F.col("_v"))).drop("_by", "_v")
    return asked.select(by, low, high, (F.col("n2") - F.col("n0")).alias("n")).where("n > 0")
