"""Toxicity by non-negative positive-unlabelled learning.

Features are the presence of words and of word beginnings of 3 to 8 bytes (A-Z lower-cased, split at
ASCII marks), hashed to 2^22.  Confirmed toxic examples are the positives; a sample of the other text, toxic
or not, is the unlabelled set.  Of texts that share word minima (copies), each sample has one, the first in the order of a hash.
Candidate features are those of several positives; kept are those most typical of positives after the
class prior's share of positives is taken out of the unlabelled rates.
A linear numpy classifier then minimises the non-negative risk
    prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)])
with the logistic loss l; when the second term is below zero, steps undo it, as in the published method.

Defined results: null and empty texts are scored by the bias alone.  Without positives all scores are 0.
A document with several labels has the largest.  Extra columns pass through; input columns named like
the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from . import _text as T
from ._shared import table

BITS = 22
PREFIXES = (3, 4, 5, 6, 7, 8)
RESULT = [StructField("score", DoubleType(), False)]


def features(part: T.Part, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hashed feature) pairs of a part; only those that the boolean table wanted marks, if given."""
    data = T.LOWER[part.data]
    words = T.find_words(data, part.offsets, T.ALNUM)
    if not words.starts.size:
        zero = np.zeros(0, dtype=np.int64)
        return zero, zero
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(T.hash_terms(data, words.starts, T.ALNUM), dtype=np.uint64)))
    rows, size = words.rows, words.ends - words.starts
    found_rows, found = [], []
    for length in (0, *PREFIXES):
        at = np.flatnonzero(size > length) if length else np.arange(size.size)
        ends = words.starts[at] + length if length else words.ends
        h = T.mix64(sums[ends] - sums[words.starts[at]] + np.uint64(length * 0x9E37 + 1)) & np.uint64((1 << BITS) - 1)
        h = h.astype(np.int64)
        if wanted is not None:
            keep = wanted[h]
            h, at = h[keep], at[keep]
        found_rows.append(rows[at])
        found.append(h)
    r, k, _ = T.count_pairs(np.concatenate(found_rows), np.concatenate(found), BITS)
    return r, k


def sketches(part: T.Part, pairs: int = 3) -> np.ndarray:
    """rows x pairs hashes, each of two minima of a row's hashed words of six bytes and more: copies share most of them, other texts hardly any.

    Rows without such words get hashes of their own."""
    data = T.LOWER[part.data]
    words = T.find_words(data, part.offsets, T.ALNUM)
    long_ones = np.flatnonzero(words.ends - words.starts >= 6)
    out = T.mix64(np.arange(part.rows, dtype=np.uint64)[:, None] + np.arange(pairs, dtype=np.uint64) * np.uint64(1 << 40))
    if long_ones.size:
        rows, h = words.rows[long_ones], T.hash_words(data, words, T.ALNUM)[long_ones]
        first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        minima = [np.minimum.reduceat(T.mix64(h + np.uint64((k + 1) << 33)), first) for k in range(2 * pairs)]
        for k in range(pairs):
            out[rows[first], k] = T.mix64(minima[2 * k] ^ (minima[2 * k + 1] << np.uint64(1)))
    return out.astype(np.int64)


@dataclass
class Model:
    """keys: the selected features in order, and their weights."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        out = np.zeros(1 << BITS, dtype=bool)
        out[self.keys] = True
        return out

    def scores(self, part: T.Part, wanted: np.ndarray) -> np.ndarray:
        if not self.keys.size:
            return np.full(part.rows, 1 / (1 + np.exp(-self.bias)))
        rows, keys = features(part, wanted)
        f = self.bias + np.bincount(rows, self.weights[np.searchsorted(self.keys, keys)], minlength=part.rows)
        return 1 / (1 + np.exp(-np.clip(f, -60, 60)))


def _feature_counts(docs: DataFrame, wanted: np.ndarray | None) -> DataFrame:
    """key, n: the number of rows of docs (text, ...) that have each feature."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BITS, dtype=np.int32)
        for batch in batches:
            for part in T.parts(batch.column(0)):
                total += np.bincount(features(part, wanted)[1], minlength=total.size).astype(np.int32)
        at = np.flatnonzero(total)
        for lo in range(0, at.size, 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[lo : lo + 100_000].astype(np.int32)), pa.array(total[at[lo : lo + 100_000]])], names=["key", "n"])

    return docs.select("text").mapInArrow(count, "key int, n int").groupBy("key").agg(F.sum("n").alias("n"))


def fit_nnpu(pos: tuple[np.ndarray, np.ndarray, int], unl: tuple[np.ndarray, np.ndarray, int], width: int, prior: float, steps: int = 600, rate: float = 0.05, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear classifier.  pos, unl: row and column of each present feature, and the number of rows."""
    w, b = np.zeros(width), np.log(prior / (1 - prior))
    m, v, mb, vb = np.zeros(width), np.zeros(width), 0.0, 0.0
    for step in range(1, steps + 1):
        out = []
        for rows, cols, n in (pos, unl):
            f = b + np.bincount(rows, w[cols], minlength=n)
            out.append((f, 1 / (1 + np.exp(-np.clip(f, -40, 40)))))
        (fp, sp), (fu, su) = out
        rest = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        grow_p, rest_p, rest_u = prior * (sp - 1) / pos[2], -prior * sp / pos[2], su / unl[2]
        gp, gu = (grow_p + rest_p, rest_u) if rest >= 0 else (-rest_p, -rest_u)
        g = np.bincount(pos[1], gp[pos[0]], minlength=width) + np.bincount(unl[1], gu[unl[0]], minlength=width) + decay * w
        gb = gp.sum() + gu.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        a, c = 1 - 0.9**step, 1 - 0.999**step
        w -= rate * (m / a) / (np.sqrt(v / c) + 1e-8)
        b -= rate * (mb / a) / (np.sqrt(vb / c) + 1e-8)
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, *, positives: int = 2500, unlabelled: int = 8000, selected: int = 2048, typical: float = 8, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit to docs; of labels (id_col, label_col) it uses the ids of label 1 and the share of 1s, the class prior.

    positives and unlabelled bound the rows of the two samples, selected the number of features kept;
    these are so many times (typical) as frequent in positives as in other texts."""
    nothing = Model(np.zeros(0, dtype=np.int64), np.zeros(0), -60.0)
    marked = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    totals = marked.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("ones")).first()
    if not totals["ones"]:
        return nothing
    prior = min(max(totals["ones"] / totals["n"], 1e-4), 0.9)
    # at most about `positives` ids: small enough to go to every executor
    known = T.bounded_sample(marked.where("y = 1"), F.col(id_col), positives, totals["ones"]).select(id_col)
    base = docs.select(F.col(id_col), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col, F.lit(5)).alias("order"))
    n_docs = docs.count()
    spread = 1 << 30
    share = int(spread * min(1.0, unlabelled / max(n_docs, 1)))
    joined = base.join(F.broadcast(known.withColumn("positive", F.lit(True))), id_col, "left").select("text", "order", F.coalesce("positive", F.lit(False)).alias("positive"), (F.pmod("order", F.lit(spread)) < share).alias("unlabelled"))

    def sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sketches(part) for part in T.parts(batch.column(0))]
            keys = np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(keys[:, k]) for k in range(3))], names=["text", "order", "positive", "unlabelled", "k0", "k1", "k2"])

    drawn = joined.where("positive or unlabelled").mapInArrow(sketched, "text string, order long, positive boolean, unlabelled boolean, k0 long, k1 long, k2 long")
    for key in ("k0", "k1", "k2"):
        # the first in the order of a hash, so that the sample is the same whatever the order of rows
        drawn = drawn.groupBy(key, "positive").agg(F.min(F.struct("order", "text", "unlabelled", *[k for k in ("k0", "k1", "k2") if k != key])).alias("r")).select("r.*", key, "positive")
    sample = table(drawn.select("text", "order", "positive", "unlabelled"), "toxicity-sample")
    sizes = sample.agg(F.sum(F.col("positive").cast("int")).alias("p"), F.sum(F.col("unlabelled").cast("int")).alias("u")).first()
    n_pos, n_unl = sizes["p"] or 0, sizes["u"] or 0
    if not n_pos or not n_unl:
        return nothing
    least = max(5, n_pos // 100) if n_pos >= 50 else 1
    # a bitmap of fixed size marks the candidates; at most n_pos * features / least of them
    counts_p = {r["key"]: r["n"] for r in _feature_counts(sample.where("positive"), None).where(F.col("n") >= least).collect()}
    if not counts_p:
        return nothing
    keys = np.array(sorted(counts_p), dtype=np.int64)
    wanted = np.zeros(1 << BITS, dtype=bool)
    wanted[keys] = True
    counts_u = {r["key"]: r["n"] for r in _feature_counts(sample.where("unlabelled"), wanted).collect()}
    p = (np.array([counts_p[k] for k in keys]) + 0.5) / (n_pos + 1)
    u = (np.array([counts_u.get(k, 0) for k in keys]) + 0.5) / (n_unl + 1)
    negative = np.maximum((u - prior * p) / (1 - prior), 0.2 / (n_unl + 1))
    gain = p * np.log(p / negative)
    gain[p < typical * negative] = 0
    best = np.argsort(-gain, kind="stable")[:selected]
    keys = np.sort(keys[best[gain[best] > 0]])
    if not keys.size:
        return nothing
    wanted = np.zeros(1 << BITS, dtype=bool)
    wanted[keys] = True

    def columns(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part in T.parts(batch.column(0)):
                r, k = features(part, wanted)
                cut = np.searchsorted(r, np.arange(part.rows + 1))
                c = np.searchsorted(keys, k).astype(np.uint16)
                found += [c[cut[i] : cut[i + 1]].tobytes() for i in range(part.rows)]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), batch.column(3), pa.array(found, pa.binary())], names=["order", "positive", "unlabelled", "cols"])

    rows = sample.select("text", "order", "positive", "unlabelled").mapInArrow(columns, "order long, positive boolean, unlabelled boolean, cols binary").collect()
    rows.sort(key=lambda r: (r["order"], bytes(r["cols"])))

    def sparse(of: list) -> tuple[np.ndarray, np.ndarray, int]:
        cols = [np.frombuffer(r["cols"], np.uint16) for r in of]
        return np.repeat(np.arange(len(of)), [c.size for c in cols]), np.concatenate(cols).astype(np.int64), len(of)

    w, b = fit_nnpu(sparse([r for r in rows if r["positive"]]), sparse([r for r in rows if r["unlabelled"]]), keys.size, prior)
    return Model(keys, w, b)


def predict(df: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """df with the score, from 0 to 1: higher is more likely toxic."""
    at = [c for c in df.columns if c != "score"].index(text_col)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        wanted = model.table()
        scores = [model.scores(part, wanted) for part in T.parts(batch.column(at))]
        return [pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())]

    return T.append_columns(df, RESULT, compute)


def held_out(id_col: str | Column = "doc_id") -> Column:
    return T.fold(id_col, mod=3) == 1


#: From this score on, a document counts as toxic.
THRESHOLD = 0.7


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from rows outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = train(docs.where(~held_out()), labels.where(~held_out()))
    out = predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
