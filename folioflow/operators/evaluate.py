"""Scores of predictions, distributions and descriptive statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(a: Column, b: Column, empty: float = 0.0) -> Column:
    return F.when(b == 0, F.lit(empty)).otherwise(a / b)


def prf(counts: DataFrame) -> DataFrame:
    """counts (tp, fp, fn) with precision, recall and f1; 0 where nothing is to be divided."""
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return counts.withColumn("precision", F.round(p, 6)).withColumn("recall", F.round(r, 6)).withColumn("f1", F.round(ratio(2 * p * r, p + r), 6))


def confusion(df: DataFrame, gold: Column, predicted: Column, *by: str) -> DataFrame:
    """tp, fp and fn of boolean columns, by group."""
    n = lambda c: F.sum(c.cast("long"))
    return df.groupBy(*by).agg(n(gold & predicted).alias("tp"), n(~gold & predicted).alias("fp"), n(gold & ~predicted).alias("fn"))


def kappa(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cohen's kappa of two label columns: one row po, pe, kappa; 1 if agreement by chance is certain."""
    table = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    rows, cols = table.groupBy(F.col(a).alias("label")).agg(F.sum("n").alias("na")), table.groupBy(F.col(b).alias("label")).agg(F.sum("n").alias("nb"))
    chance = rows.join(cols, "label", "outer").agg(F.sum(F.coalesce("na", F.lit(0)) * F.coalesce("nb", F.lit(0))).alias("chance"))
    totals = table.agg(F.sum("n").alias("n"), F.sum(F.when(F.col(a) == F.col(b), F.col("n")).otherwise(0)).alias("same"))
    both = totals.crossJoin(chance)  # one row each
    po, pe = F.col("same") / F.col("n"), F.col("chance") / (F.col("n") * F.col("n"))
    return both.select(F.round(po, 6).alias("po"), F.round(pe, 6).alias("pe"), F.round(F.when(pe >= 1, 1.0).otherwise((po - pe) / (1 - pe)), 6).alias("kappa"))


def entropy(df: DataFrame, label: str) -> DataFrame:
    """Shannon entropy of a label's distribution, in bits."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    p = F.col("n") / F.sum("n").over(Window.partitionBy())  # one row per label
    return counts.select(p.alias("p")).agg(F.round(F.sum(-F.col("p") * F.log2("p")), 6).alias("entropy"))


def describe(df: DataFrame, value: str, *by: str) -> DataFrame:
    """Count, total, mean, median, 95th and 99th percentile, least, most and population deviation."""
    v = F.col(value)
    q = lambda p: F.round(F.percentile(v, F.lit(p)), 6)
    return df.groupBy(*by).agg(
        F.count(v).alias("n"), F.round(F.sum(v), 4).alias("total"), F.round(F.avg(v), 6).alias("mean"), q(0.5).alias("median"),
        q(0.95).alias("p95"), q(0.99).alias("p99"), F.min(v).alias("least"), F.max(v).alias("most"), F.round(F.stddev_pop(v), 6).alias("deviation"),
    )


def class_weights(df: DataFrame, label: str, power: float = 0.25) -> DataFrame:
    """Inverse frequencies to a power, divided by their mean."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()  # one row per label
    w = F.pow(F.sum("n").over(every) / F.greatest("n", F.lit(1)), F.lit(power))
    return counts.withColumn("w", w).select(label, "n", F.round(F.col("w") / F.avg("w").over(every), 6).alias("weight"))


def multiset_match(gold: DataFrame, predicted: DataFrame, keys: list[str]) -> DataFrame:
    """tp, fp, fn of two multisets of rows by keys: equal rows match one to one."""
    a, b = gold.groupBy(*keys).agg(F.count(F.lit(1)).alias("a")), predicted.groupBy(*keys).agg(F.count(F.lit(1)).alias("b"))
    both = a.join(b, keys, "outer").select(F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"), *[k for k in keys if k == "label"])
    by = [k for k in keys if k == "label"]
    return both.groupBy(*by).agg(F.sum(F.least("a", "b")).alias("tp"), F.sum(F.greatest(F.col("b") - F.col("a"), F.lit(0))).alias("fp"), F.sum(F.greatest(F.col("a") - F.col("b"), F.lit(0))).alias("fn"))
