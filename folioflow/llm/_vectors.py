"""Vectors of a table as bytes of 64-bit or 32-bit numbers, without those that take no part."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType


def usable(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, type]:
    """(vec_id, vec, dim) of the rows with an id and a vector that is not null or zero and has only finite numbers; and numpy's type of vec.

    vec has the components as they are: 32-bit numbers of float arrays, else 64-bit ones."""
    kind = df.schema[vector_col].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    number = np.dtype("<f4" if single else "<f8")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten()
            missing = flat.is_null().to_numpy(zero_copy_only=False)
            values = np.where(missing, np.nan, pc.fill_null(flat, 0).to_numpy(zero_copy_only=False)).astype(number)
            ends = np.cumsum(sizes)
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
            some = np.concatenate(([0], np.cumsum(values != 0)))
            good = np.flatnonzero((bad[ends] == bad[ends - sizes]) & (some[ends] > some[ends - sizes]) & batch.column(0).is_valid().to_numpy(zero_copy_only=False))
            vecs = [(values[ends[i] - sizes[i] : ends[i]] + number.type(0)).tobytes() for i in good]  # -0 becomes 0
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(good)), pa.array(vecs, pa.binary()), pa.array(sizes[good].astype(np.int32))], names=["vec_id", "vec", "dim"])

    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>" if single else "array<double>").alias("v"))
    return rows.mapInArrow(run, "vec_id long, vec binary, dim int"), number


def dimensions(vectors: DataFrame) -> list[int]:
    """The lengths of vectors that occur; only vectors of one length are compared."""
    return sorted(r["dim"] for r in vectors.select("dim").distinct().collect())


def stack(vecs: Iterable[bytes], number: np.dtype) -> np.ndarray:
    """Vectors as rows of 64-bit numbers."""
    raw = list(vecs)
    return np.frombuffer(b"".join(raw), dtype=number).reshape(len(raw), -1).astype(np.float64)


def groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of sorted batches by their first columns: the key, and the other columns of its rows."""
    current, rows = None, []
    for batch in batches:
        for lo in range(0, batch.num_rows, 2048):
            for row in zip(*(c.to_pylist() for c in batch.slice(lo, 2048).columns), strict=True):
                if row[:keys] != current:
                    if rows:
                        yield current, rows
                    current, rows = row[:keys], []
                rows.append(row[keys:])
    if rows:
        yield current, rows


def matrix(vecs: pa.Array, number: np.dtype) -> np.ndarray:
    """A binary column of vectors of one length as rows of 64-bit numbers."""
    vecs = vecs.cast(pa.binary())
    ends = np.frombuffer(vecs.buffers()[1], dtype=np.int32)[vecs.offset : vecs.offset + len(vecs) + 1]
    flat = np.frombuffer(vecs.buffers()[2], dtype=number, count=int(ends[-1] - ends[0]) // number.itemsize, offset=int(ends[0]))
    return flat.reshape(len(vecs), -1).astype(np.float64)


def runs(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Runs of rows alike in their first columns, integers without nulls, of sorted batches: the key, and the rows."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        columns = [batch.column(k).to_numpy() for k in range(keys)]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        cuts = [0, *new.tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield tuple(int(c[a]) for c in columns), batch.slice(a, b - a)
        held = batch.slice(cuts[-1])
    if held is not None:
        yield tuple(int(held.column(k)[0].as_py()) for k in range(keys)), held
