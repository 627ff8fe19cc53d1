"""Vectorised text primitives over Arrow string columns, shared by the operators of this subpackage.

Everything works on the UTF-8 bytes of an Arrow string column as numpy arrays, in parts of bounded
size, so that no operator runs Python code per word.  Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Bytes and rows of a part; a single longer text makes a part of its own.
PART_BYTES, PART_ROWS = 1 << 21, 4096

_rng = np.random.default_rng(20_240_501)
#: A random 64-bit value for each byte value, and the base of the polynomial word hash.
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, dtype=np.uint64)

#: Byte maps: ASCII upper case to lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words that are split at ASCII white space.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 9, 10, 11, 12, 13]] = False
#: Bytes of words of letters and digits: ASCII ones (lower case) and all of multi-byte characters.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> np.ndarray:
    """The first n powers of the hash base modulo 2^64."""
    global _powers
    if _powers.size < n:
        steps = np.full(max(n, 2 * _powers.size), _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


@dataclass
class Part:
    """Rows lo..hi of a column: their bytes, and the place of each row's bytes."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return self.hi - self.lo


def parts(column: pa.Array, max_bytes: int = PART_BYTES, max_rows: int = PART_ROWS) -> Iterator[Part]:
    """Cut a string column into parts of whole rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, values = column.buffers()
    offsets = np.frombuffer(places, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), lo + max_rows, n)
        yield Part(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


@dataclass
class Words:
    """Words of a part: where each begins and ends, how many each row has, and the row of each."""

    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(self.counts.size), self.counts)

    @property
    def first(self) -> np.ndarray:
        """Index of each row's first word, and the number of words at the end."""
        return np.concatenate(([0], np.cumsum(self.counts)))


def find_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    """Maximal runs of bytes that are inside, within each row."""
    n = data.size
    if not n:
        zero = np.zeros(0, dtype=np.int64)
        return Words(zero, zero, np.zeros(offsets.size - 1, dtype=np.int64))
    m = inside[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], m[:-1])) & ~edge[:-1]
    after = np.concatenate((m[1:], [False])) & ~edge[1:]
    starts = np.flatnonzero(m & ~before)
    ends = np.flatnonzero(m & ~after) + 1
    return Words(starts, ends, np.diff(np.searchsorted(starts, offsets)))


def hash_terms(data: np.ndarray, starts: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """For each byte, its term of its word's polynomial hash; 0 outside of words."""
    table = np.where(inside, _BYTE, np.uint64(0))
    out = table[data]
    gaps = np.diff(np.append(starts, data.size))
    place = np.arange(starts[0], data.size) - np.repeat(starts, gaps)
    out[: starts[0]] = 0
    out[starts[0] :] *= powers(int(gaps.max()))[place]
    return out


def hash_words(data: np.ndarray, words: Words, inside: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not words.starts.size:
        return np.zeros(0, dtype=np.uint64)
    sums = np.add.reduceat(hash_terms(data, words.starts, inside), words.starts)
    return mix64(sums + (words.ends - words.starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def count_pairs(rows: np.ndarray, keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, key) pairs in order, and how often each occurs; keys have so many bits at most."""
    both, counts = np.unique((rows.astype(np.int64) << bits) | keys.astype(np.int64), return_counts=True)
    return both >> bits, both & ((1 << bits) - 1), counts


def has_letter(column: pa.Array, part: Part, ascii_letters: np.ndarray) -> np.ndarray:
    """Whether each row has a letter of any script."""
    out = ascii_letters > 0
    for i in np.flatnonzero(~out & (np.diff(part.offsets) > 0)):
        raw = part.data[part.offsets[i] : part.offsets[i + 1]]
        out[i] = bool((raw >= 0x80).any()) and any(c.isalpha() for c in raw.tobytes().decode("utf-8", "replace"))
    return out


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each row's values."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def spread(df: DataFrame) -> DataFrame:
    """df, dealt out anew if it has fewer partitions than there are cores; larger inputs stay as they are read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def append_columns(df: DataFrame, fields: list[StructField], compute: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """df with more columns, which compute makes of each Arrow batch.  Columns of df with the same names go."""
    new = {f.name for f in fields}
    base = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in new])
    names = [*base.columns, *[f.name for f in fields]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *compute(batch)], names=names)

    return base.mapInArrow(run, StructType([*base.schema.fields, *fields]))


def fold(doc_id: str | Column = "doc_id", *, mod: int) -> Column:
    """crc32 of the id as text, modulo mod; a null id counts as empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def bounded_sample(df: DataFrame, key: Column, bound: int, count: int | None = None) -> DataFrame:
    """About bound rows of df at most, chosen by a hash of the key, the same at every run.

    The fraction follows from the number of rows; all rows stay if there are no more than bound."""
    total = df.count() if count is None else count
    if total <= bound:
        return df
    spread = 1 << 30
    return df.where(F.pmod(F.xxhash64(key), F.lit(spread)) < F.lit(int(spread * bound / total)))
