"""Selection of documents that differ from each other, within budgets of tokens."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.sources import writers


def standardised(rows: DataFrame, v: str) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """rows with v standardised by component, and what was taken from it and divided by; sums of one row for each component come to the driver."""
    x = rows.select(F.posexplode(v).alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).orderBy("i").collect()
    mean, dev = np.array([r["m"] for r in x], dtype=float), np.array([r["s"] for r in x], dtype=float) + 1e-6
    m, s = (F.array(*(F.lit(float(y)) for y in a)) for a in (mean, dev))
    scale = F.transform(F.arrays_zip(F.col(v).alias("v"), m.alias("m"), s.alias("s")), lambda t: (t["v"].cast("double") - t["m"]) / t["s"])
    return rows.withColumn(v, scale), mean, dev


class Pool:
    """The rows of a tier and size that are farthest from the chosen ones, and where the rest begins (floor), as (-distance, id)."""

    def __init__(self, rows: list, more: bool) -> None:
        self.rows, self.gaps, self.v = rows, np.array([r["gap"] for r in rows]), np.array([r["v"] for r in rows])
        self.floor = (-rows[-1]["gap"], rows[-1]["id"]) if more else (np.inf, rows[-1]["id"])

    def best(self) -> tuple:
        return min((-g, r["id"]) for g, r in zip(self.gaps, self.rows, strict=True))

    def pop(self):
        i = min(range(len(self.rows)), key=lambda i: (-self.gaps[i], self.rows[i]["id"]))
        self.gaps, self.v = np.delete(self.gaps, i), np.delete(self.v, i, axis=0)
        return self.rows.pop(i)

    def lower(self, v: np.ndarray) -> None:
        if self.rows:
            self.gaps = np.minimum(self.gaps, np.linalg.norm(self.v - v, axis=1))


def farthest_first_quotas(rows: DataFrame, id_col: str, tier: str, tokens: str, v: str, quotas: dict[str, int], cap: int, *, pool: int = 200) -> DataFrame:
    """place, id, tier, tokens of the chosen rows, in the order of choice (SEQ-40).

    Vectors are standardised.  The first row is, of those of the first tier of quotas within cap tokens (of all rows if there are none),
    the nearest to their mean; then each is the farthest from those chosen before (ties to the smaller id) among the tiers whose
    tokens do not fill their quota yet.  Rows above the cap come only where no smaller one is left in such tiers.

    A pass over all rows lowers their distances by the newly chosen rows and brings the pool farthest of each tier and size
    to the driver.  Distances only fall, so choices from the pools are those from all rows as long as they are not below what a pool
    left behind.  The driver holds the pools and the chosen rows, which the quotas bound.  Vectors must be finite and of one length;
    rows without a vector, an id or tokens, and those of tiers without a quota, are never chosen; ids are taken to be unique."""
    spark = rows.sparkSession
    rows = rows.select(F.col(id_col).alias("id"), F.col(tier).cast("string").alias("tier"), F.col(tokens).cast("long").alias("tokens"), F.col(v).alias("v"))
    rows = rows.where("id is not null and tokens is not null and v is not null")
    schema = f"place int, {id_col} {dict(rows.dtypes)['id']}, {tier} string, {tokens} long"
    scaled, mean, _ = standardised(rows, "v")
    if not mean.size:
        return spark.createDataFrame([], schema)
    state = scaled.withColumn("small", F.col("tokens") <= cap).withColumn("gap", F.lit(float("inf")))
    gap = lambda a, b: (F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, z: s + z))
    literal = lambda x: F.array(*(F.lit(float(y)) for y in x))
    first_tier = (F.col("tier") == next(iter(quotas), None)) & F.col("small")
    start = state.where(first_tier)
    if start.isEmpty():
        start = state
    middle = [r["m"] for r in start.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m")).orderBy("i").collect()]
    new = [start.orderBy(gap(F.col("v"), literal(middle)), "id").select("id", "tier", "tokens", "small", "v").first()]
    left = {(r["tier"], r["small"]): r["n"] for r in state.groupBy("tier", "small").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen, filled = [], dict.fromkeys(quotas, 0)

    def take(r) -> None:
        chosen.append((len(chosen), r["id"], r["tier"], r["tokens"]))
        left[r["tier"], r["small"]] -= 1
        if r["tier"] in filled:
            filled[r["tier"]] += r["tokens"]

    def open_classes() -> set[tuple[str, bool]]:
        short = {t for t in quotas if filled[t] < quotas[t]}
        small = {(t, True) for t in short if left.get((t, True), 0) > 0}
        return small or {(t, False) for t in short if left.get((t, False), 0) > 0}

    last = new[0]
    take(last)
    while open_classes():
        done, targets = [r["id"] for r in new], np.array([r["v"] for r in new])

        @F.pandas_udf("double")
        def near(x: pd.Series) -> pd.Series:
            m = np.stack(x)
            return pd.Series(np.min([np.linalg.norm(m - c, axis=1) for c in targets], axis=0))

        path = writers.scratch(spark, "distances")
        state.where(~F.col("id").isin(done)).withColumn("gap", F.least("gap", near("v"))).write.parquet(path)
        state = spark.read.parquet(path)
        pools = {}
        for t, small in sorted(open_classes()):
            found = state.where((F.col("tier") == t) & (F.col("small") == small)).orderBy(F.desc("gap"), "id").limit(pool).collect()
            left[t, small] = left[t, small] if found else 0
            if found:
                pools[t, small] = Pool(found, len(found) == pool)
        new = []
        while (kinds := open_classes()) and kinds <= pools.keys() and all(pools[k].rows for k in kinds):
            where = min(kinds, key=lambda k: pools[k].best())
            if any(pools[where].best() > pools[k].floor for k in kinds):
                break
            r = pools[where].pop()
            take(r)
            new.append(r)
            for own in pools.values():
                own.lower(np.array(r["v"]))
        new = new or [last]  # nothing new where ids repeat
        last = new[-1]
    return spark.createDataFrame(chosen, schema)
