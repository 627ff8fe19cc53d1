"""Language identification by nearest centroids.

Texts become L2-normalised TF-IDF vectors of hashed byte 2- and 3-grams (letters lower-cased, other
ASCII as space).  Each language of the training rows gets several centroids by spherical k-means over a
bounded sample of its rows; document frequencies come from all training rows.  A text gets the language
of the centroid with the largest cosine, and is rejected if its distance to that centroid is beyond what
training texts of about its length show.

Defined results: a null text or one without any letter is `und`, score 0, rejected; so is every text if
there are no training rows.  Ties go to the language that sorts first.  Repeated rows are scored alike.
Extra columns pass through; input columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField

from . import _text as T

DIM = 4096
UND = "und"
#: Length bands of the rejection distances: a text with n grams is in band log2(n).
BANDS = 24

_rng = np.random.default_rng(11)
_GRAM = _rng.integers(0, DIM, (5, 256), dtype=np.uint16)
#: Letters in lower case; multi-byte characters as they are; all else is a space.
_LETTERS = np.where(np.isin(T.LOWER, np.arange(97, 123)) | (np.arange(256) >= 0x80), T.LOWER, 32).astype(np.uint8)
_ASCII_LETTER = np.isin(T.LOWER, np.arange(97, 123))

RESULT = [StructField("lang_pred", StringType(), False), StructField("score", DoubleType(), False), StructField("rejected", BooleanType(), False), StructField("distance", DoubleType(), False)]


@dataclass
class Model:
    """langs: the language of each centroid.  limits: by band, the largest accepted distance."""

    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]
    limits: np.ndarray


def gram_counts(part: T.Part) -> np.ndarray:
    """rows x DIM: how often each hashed gram occurs.  Grams do not cross rows; those of spaces only are left out."""
    x = _LETTERS[part.data]
    rows = np.repeat(np.arange(part.rows), np.diff(part.offsets))
    out = np.zeros(part.rows * DIM, dtype=np.int64)
    for n in (2, 3):
        if x.size < n:
            continue
        m = x.size - n + 1
        h = _GRAM[2 * n - 4][x[:m]] ^ _GRAM[2 * n - 3][x[1 : m + 1]]
        if n == 3:
            h = h ^ _GRAM[4][x[2 : m + 2]]
        good = (rows[:m] == rows[n - 1 :]) & ((x[:m] != 32) | (x[1 : m + 1] != 32))
        out += np.bincount(rows[:m][good] * DIM + h[good], minlength=out.size)
    return out.reshape(part.rows, DIM)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = np.log1p(counts.astype(np.float32)) * idf
    norm = np.sqrt(np.einsum("ij,ij->i", w, w))
    return w / np.maximum(norm, 1e-12)[:, None]


def _clusters(x: np.ndarray, k: int, seed: int = 3, rounds: int = 12) -> np.ndarray:
    """Spherical k-means with spread-out starts."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centres = x[[int(rng.integers(len(x)))]]
    while len(centres) < k:
        far = np.maximum(1 - (x @ centres.T).max(axis=1), 0).astype(np.float64) ** 2
        if far.sum() <= 1e-9:
            break
        centres = np.vstack((centres, x[int(rng.choice(len(x), p=far / far.sum()))]))
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        new = np.stack([x[own == j].mean(axis=0) if (own == j).any() else c for j, c in enumerate(centres)])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.abs(new - centres).max() < 1e-5:
            break
        centres = new
    return centres.astype(np.float32)


def train(rows: DataFrame, *, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id", sample_per_lang: int = 800, clusters: int = 4) -> Model | None:
    """Fit on rows with a text and a language.

    sample_per_lang bounds the rows per language that k-means and the rejection distances see; document
    frequencies and language counts are those of all rows."""
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(key_col, text_col).alias("order")).where("text is not null and lang is not null")
    totals = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        return None

    def frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, docs = np.zeros(DIM, dtype=np.int64), 0
        for batch in batches:
            for part in T.parts(batch.column(0), max_rows=512):
                total += (gram_counts(part) > 0).sum(axis=0)
                docs += part.rows
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(DIM), -1), pa.int32()), pa.array(np.append(total, docs), pa.int64())], names=["gram", "n"])

    df = np.zeros(DIM + 1, dtype=np.int64)
    for r in rows.select("text").mapInArrow(frequencies, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        df[r["gram"]] = r["n"]
    idf = np.log((1.0 + df[-1]) / (1.0 + df[:-1])).astype(np.float32) + np.float32(0.1)

    spread = 1 << 30
    chosen = F.lit(False)
    for lang, n in sorted(totals.items()):
        chosen = chosen | ((F.col("lang") == lang) & (F.pmod("order", F.lit(spread)) < int(spread * min(1, sample_per_lang / n))))

    def sparse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, counts = [], []
            for part in T.parts(batch.column(0), max_rows=512):
                for row in gram_counts(part):
                    at = np.flatnonzero(row)
                    grams.append(at.astype(np.uint16).tobytes())
                    counts.append(np.minimum(row[at], 65535).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(grams, pa.binary()), pa.array(counts, pa.binary())], names=["lang", "order", "grams", "counts"])

    # repeated rows count once, and ids of very many texts don't fill the driver
    drawn = rows.where(chosen).groupBy("lang", "order").agg(F.min("text").alias("text")).select("text", "lang", "order")
    sample = drawn.mapInArrow(sparse, "lang string, order long, grams binary, counts binary").orderBy("order", "lang").limit(2 * sample_per_lang * len(totals)).collect()
    sample.sort(key=lambda r: (r["lang"], r["order"], bytes(r["grams"])))
    centroids, langs, near, sizes = [], [], [], []
    for lang in sorted(totals):
        own = [r for r in sample if r["lang"] == lang][: 2 * sample_per_lang]
        counts = np.zeros((len(own), DIM), dtype=np.float32)
        for i, r in enumerate(own):
            counts[i, np.frombuffer(r["grams"], np.uint16)] = np.frombuffer(r["counts"], np.uint16)
        size, x = counts.sum(axis=1), weigh(counts, idf)
        del counts
        x, size = x[size > 0], size[size > 0]
        if len(x):
            c = _clusters(x, clusters)
            centroids.append(c)
            langs += [lang] * len(c)
            near.append(1 - (x @ c.T).max(axis=1))
            sizes.append(size)
    if not langs:
        return None
    return Model(idf, np.vstack(centroids), langs, _limits(np.concatenate(near), np.concatenate(sizes)))


def _limits(distance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """By band, mean plus six deviations of the distances of training texts of that or a neighbouring band; 1 at most.

    A band with under 20 texts takes the limit of the next longer one that has them."""
    band = np.clip(np.log2(size), 0, BANDS - 1).astype(int)
    limits = np.full(BANDS, np.nan)
    for b in range(BANDS):
        d = distance[np.abs(band - b) <= 1]
        if len(d) >= 20:
            limits[b] = d.mean() + 6 * d.std() + 0.02
    known = np.flatnonzero(~np.isnan(limits))
    if not known.size:
        return np.full(BANDS, 0.999)
    for b in range(BANDS):
        if np.isnan(limits[b]):
            limits[b] = limits[known[known > b][0]] + 0.05 * (known[known > b][0] - b) if (known > b).any() else limits[known[-1]]
    return np.minimum(limits, 0.999)


def predict(df: DataFrame, model: Model | None, *, text_col: str = "text") -> DataFrame:
    """df with lang_pred, score (cosine, 0 to 1), rejected and distance (1 - cosine)."""
    at = [c for c in df.columns if c not in {f.name for f in RESULT}].index(text_col)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        column, best, cosine, size, letter = batch.column(at), [], [], [], []
        for part in T.parts(column, max_rows=512):
            counts = gram_counts(part)
            size.append(counts.sum(axis=1))
            letter.append(T.has_letter(column, part, T.row_sums(_ASCII_LETTER[part.data], part.offsets)))
            if model is not None:
                similar = weigh(counts, model.idf) @ model.centroids.T
                best.append(similar.argmax(axis=1))
                cosine.append(similar.max(axis=1).astype(np.float64))
        if not size:
            return [pa.array([], f) for f in (pa.string(), pa.float64(), pa.bool_(), pa.float64())]
        known = np.concatenate(letter)
        if model is None:
            n = len(known)
            return [pa.array([UND] * n), pa.array(np.zeros(n)), pa.array(np.ones(n, dtype=bool)), pa.array(np.ones(n))]
        score = np.where(known, np.clip(np.concatenate(cosine), 0, 1), 0.0)
        band = np.clip(np.log2(np.maximum(np.concatenate(size), 1)), 0, BANDS - 1).astype(int)
        rejected = ~known | (1 - score > model.limits[band])
        names = np.where(known, np.array(model.langs, dtype=object)[np.concatenate(best)], UND)
        return [pa.array(names, pa.string()), pa.array(score), pa.array(rejected), pa.array(1 - score)]

    return T.append_columns(df, RESULT, compute)


def held_out() -> Column:
    return T.fold(mod=4) == 2


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learnt from those outside the held-out fold."""
    docs = T.spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"))
    model = train(docs.where(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
