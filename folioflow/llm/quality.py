"""Quality classifier: random-indexing vectors, pooled per document, and a two-layer network.

Every word gets a fixed sparse random index vector by its hash; its context vector is the sum of its
neighbours' index vectors over the whole corpus (hashed to BUCKETS rows).  Besides the word itself, its
shape (kinds of first and last character, case, length class) is a unit with a context vector of its
own.  A document is pooled as the means over its words, over its distinct words and over its shapes,
the deviations over its words, and a few counts.  A numpy network with one hidden layer is fitted to a
bounded sample of labelled rows; a temperature, fitted on rows that the network did not see,
calibrates its probabilities.

Defined results: null and empty texts are scored like any other, by their all-zero pooled vector.
Without labelled rows of both classes, the score is the share of class 1 (0.5 if there are no labels).
A document with several labels has the largest.  Extra columns pass through; input columns named like
the results are replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from . import _text as T

BUCKETS, SHAPES, DIM = 1 << 14, 1 << 10, 32
#: Rows of the context matrix that travel together.
_SLICE = 1 << 10
WIDTH = 5 * DIM + 4

_rng = np.random.default_rng(29)
#: Two places and signs for each bucket: its random index vector.
_PLACE = _rng.integers(0, DIM, (2, BUCKETS + SHAPES))
_SIGN = _rng.choice([-1.0, 1.0], (2, BUCKETS + SHAPES))

#: Kinds of bytes: lower, upper, digit, multi-byte, and ten kinds of marks.
_KIND = np.full(256, 13, dtype=np.int64)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 0
for _i, _c in enumerate(b".,!#%&*$|"):
    _KIND[_c] = 4 + _i
_LOWER = np.zeros(256, dtype=bool)
_LOWER[97:123] = _LOWER[128:] = True

RESULT = [StructField("score", DoubleType(), False)]


def _units(part: T.Part) -> tuple[T.Words, np.ndarray, np.ndarray]:
    """Words of a part, their buckets, and the buckets of their shapes (from BUCKETS on)."""
    words = T.find_words(part.data, part.offsets, T.SPACED)
    if not words.starts.size:
        zero = np.zeros(0, dtype=np.int64)
        return words, zero, zero
    bucket = (T.hash_words(part.data, words, T.SPACED) & np.uint64(BUCKETS - 1)).astype(np.int64)
    lower = np.add.reduceat(_LOWER[part.data], words.starts, dtype=np.int64) > 0
    size = np.digitize(words.ends - words.starts, [2, 5, 10])
    shape = ((_KIND[part.data[words.starts]] % 5) * 14 + _KIND[part.data[words.ends - 1]]) * 8 + lower * 4 + size
    return words, bucket, BUCKETS + shape


def _sums(slices: dict[int, np.ndarray]) -> pa.RecordBatch:
    """Rows of a matrix of sums.  Sums of signs are whole numbers: they add up to the same whatever the order."""
    return pa.RecordBatch.from_arrays([pa.array(list(slices), pa.int32()), pa.array([zlib.compress(x.astype(np.int64).tobytes(), 1) for x in slices.values()], pa.binary())], names=["slice", "sums"])


def context_matrix(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """(BUCKETS + SHAPES) x DIM unit vectors: sums of the neighbours' index vectors over all documents."""
    units = BUCKETS + SHAPES

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(units * DIM)
        for batch in batches:
            for part in T.parts(batch.column(0)):
                words, bucket, shape = _units(part)
                if bucket.size < 2:
                    continue
                rows = words.rows
                pair = rows[1:] == rows[:-1]
                for own in (bucket, shape):
                    for a, b in ((own[:-1][pair], own[1:][pair]), (own[1:][pair], own[:-1][pair])):
                        for s in (0, 1):
                            total += np.bincount(a * DIM + _PLACE[s][b], weights=_SIGN[s][b], minlength=total.size)
        yield _sums(dict(enumerate(total.reshape(-1, _SLICE * DIM))))

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(zlib.decompress(x.as_buffer()), np.int64)
        yield _sums(total)

    # a tree of sums: each level leaves the square root of the partial matrices, and each task holds one matrix
    schema = "slice int, sums binary"
    partial, left = docs.select(text_col).mapInArrow(collect, schema), docs.rdd.getNumPartitions()
    while left > 64:
        left = math.isqrt(left)
        partial = partial.withColumn("part", F.spark_partition_id()).repartition(left, "part").select("slice", "sums").mapInArrow(add, schema)
    out = np.zeros((units // _SLICE, _SLICE * DIM))
    for r in partial.repartition("slice").mapInArrow(add, schema).collect():
        out[r["slice"]] = np.frombuffer(zlib.decompress(r["sums"]), np.int64)
    out = out.reshape(units, DIM).astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _mean(x: np.ndarray, weights: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Weighted mean of the x of each row; rows ascend."""
    out = np.zeros((n, x.shape[1]), dtype=np.float64)
    if len(rows):
        first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        out[rows[first]] = np.add.reduceat(x * weights[:, None], first, axis=0)
        out[rows[first]] /= np.add.reduceat(weights, first)[:, None]
    return out


def pool(part: T.Part, context: np.ndarray) -> np.ndarray:
    """rows x WIDTH features."""
    words, bucket, shape = _units(part)
    rows, n = words.rows, part.rows
    r, b, c = T.count_pairs(rows, bucket, 15)
    x, c = context[b], c.astype(np.float32)
    mean = _mean(x, c, r, n)
    spread = np.sqrt(np.maximum(_mean(x * x, c, r, n) - mean**2, 0))
    even = _mean(x, np.ones_like(c), r, n)
    s, k, m = T.count_pairs(rows, shape, 15)
    shapes = _mean(context[k], m.astype(np.float32), s, n)
    shape_spread = np.sqrt(np.maximum(_mean(context[k] ** 2, m.astype(np.float32), s, n) - shapes**2, 0))
    distinct = np.bincount(r, minlength=n)
    sizes = np.stack((np.log1p(words.counts), np.log1p(np.diff(part.offsets)), distinct / np.maximum(words.counts, 1), np.bincount(s, minlength=n) / np.maximum(words.counts, 1)), axis=1)
    return np.hstack((mean, spread, even, shapes, shape_spread, sizes)).astype(np.float32)


@dataclass
class Model:
    context: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float] | None
    temperature: float
    share: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.layers
        return np.tanh((x - self.centre) / self.scale @ w + b) @ v + c

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(self.logits(x).astype(np.float64) / self.temperature, -50, 50)))


def _fit(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, rate: float = 5e-3, decay: float = 1e-4) -> tuple:
    """Weights of the two layers, by Adam on the logistic loss."""
    rng = np.random.default_rng(17)
    p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), 256):
            at = order[lo : lo + 256]
            h = np.tanh(x[at] @ p[0] + p[1])
            g = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - y[at]) / len(at)
            back = np.outer(g, p[2]) * (1 - h * h)
            grads = [x[at].T @ back + decay * p[0], back.sum(axis=0), h.T @ g + decay * p[2], np.array([g.sum()])]
            step += 1
            for i, d in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * d
                v[i] = 0.999 * v[i] + 0.001 * d * d
                p[i] -= rate * (1 - epoch / epochs) * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return p[0].astype(np.float32), p[1].astype(np.float32), p[2].astype(np.float32), float(p[3][0])


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the least logistic loss, among a fine range of them."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 120))
    loss = [np.logaddexp(0, -(2 * y - 1) * logits / t).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(docs: DataFrame, labels: DataFrame, *, sample: int = 12_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", context: np.ndarray | None = None) -> Model:
    """Fit to documents that labels (id_col, label_col) mark.

    sample bounds the labelled rows that the network and the temperature see; the context vectors are
    those of all documents."""
    context = context_matrix(docs, text_col) if context is None else context
    marked = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    totals = marked.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("ones")).first()
    share = (totals["ones"] or 0) / totals["n"] if totals["n"] else 0.5
    nothing = Model(context, np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32), None, 1.0, share)
    if not 0 < share < 1:
        return nothing
    # at most about `sample` rows of two numbers: small enough to go to every executor
    some = T.bounded_sample(marked, F.col(id_col), sample, totals["n"]).select(F.col(id_col).alias("id"), "y")

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [pool(part, context) for part in T.parts(batch.column(0))]
            rows = [r.tobytes() for r in np.concatenate(x)] if x else []
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(rows, pa.binary())], names=["order", "y", "x"])

    drawn = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(some), "id").select("text", F.xxhash64("id", "text").alias("order"), "y")
    # repeated rows count once, and an id of very many texts doesn't fill the driver
    drawn = drawn.groupBy("order", "y").agg(F.min("text").alias("text")).select("text", "order", "y")
    rows = drawn.mapInArrow(features, "order long, y int, x binary").orderBy("order", "y").limit(2 * sample).collect()
    rows.sort(key=lambda r: (r["order"], bytes(r["x"])))
    if not rows:
        return nothing
    x, y = np.stack([np.frombuffer(r["x"], np.float32) for r in rows]), np.array([r["y"] for r in rows], dtype=np.float64)
    if not 0 < y.mean() < 1:
        return nothing
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z, apart = (x - centre) / scale, np.arange(len(x)) % 5 == 4
    layers = _fit(z[~apart], y[~apart]) if apart.any() else _fit(z, y)
    model = Model(context, centre, scale, layers, 1.0, share)
    if apart.any():
        model.temperature = temperature(model.logits(x[apart]).astype(np.float64), y[apart])
    return model


def predict(df: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """df with the score: the calibrated probability of class 1."""
    at = [c for c in df.columns if c != "score"].index(text_col)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        scores = [model.scores(pool(part, model.context)) for part in T.parts(batch.column(at))]
        return [pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())]

    return T.append_columns(df, RESULT, compute)


def held_out(id_col: str | Column = "doc_id") -> Column:
    return T.fold(id_col, mod=5) == 0


#: From this score on, a document counts as of class 1.
THRESHOLD = 0.3


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learnt from the labels outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").where(~held_out())
    model = train(docs, labels)
    out = predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
