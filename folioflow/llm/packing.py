"""Packing of tokenised documents into sequences of bounded length, by linear grouping and best fit.

Only lengths go to the planner, as a histogram of at most `capacity` numbers.  It rounds large lengths up
within groups of equal cardinality, finds the best configurations of the few sizes (a linear programme by
column generation), rounds their multiplicities down and substitutes actual lengths: the longest that is left
of each group, and in the last slot of a configuration the longest large one that fits, so that little of what
was rounded up is lost.  What is left, longest first, and then the small lengths go where they fit best.  The
planner does so with a few bounds of what is large and numbers of groups, and keeps the
plan with the fewest sequences.  The plan is a table of runs: the documents of one length with
ranks lo..hi go to consecutive sequences.  Its size depends on the capacity and the number of groups, not
on the number of documents.  Each document finds its place by its length and its rank among those of that
length; ranks are counted for each input partition and summed up.

Defined results: a null text is empty and still has its end token; repeated rows are packed as rows of
their own.  Only documents beyond the capacity are cut; their first piece has what is left over from
whole pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._bytebpe import load
from ._shared import table
from ._text import spread

CAPACITY = 2048
#: Longer pieces than this share of the capacity are large, in so many groups; each is tried.
SCHEMES = ((1 / 4, 64), (1 / 4, 32), (1 / 8, 16))


def pieces(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and part and rank: a number of the input partition, and how many pieces of that length it had before."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part = load(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            rows: list[tuple] = []
            for i, text in enumerate(batch.column(1)):
                ids = np.append(bpe.encode(text.as_py() or ""), np.uint32(end)).astype("<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((i, k, lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes()), seen[hi - lo]))
                    seen[hi - lo] += 1
            columns = list(zip(*rows, strict=True)) or [()] * 6
            own = batch.column(0).take(pa.array(columns[0], pa.int64()))
            more = [pa.array(c, t) for c, t in zip(columns[1:], (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays([own, *more, pa.array([part] * len(own), pa.int32())], names=["doc_id", "piece", "start", "length", "ids_crc32", "rank", "part"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, rank long, part int")


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 2000) -> list[tuple[np.ndarray, float]]:
    """Configurations (how many of each size) and their multiplicities, which cover the demand with the least
    sum of multiplicities: the linear programme, by column generation with a knapsack for each new column."""
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    room = np.arange(capacity + 1)
    fits = room[:, None] >= sizes[None, :]
    rest = np.where(fits, room[:, None] - sizes[None, :], 0)
    for _ in range(rounds):
        price = np.linalg.solve(basis.T, np.ones(m))
        # value[c]: the most that one, two, ... pieces within c are worth; picks: the piece added last
        gain, value, picks = np.where(fits, np.maximum(price, 0), -np.inf), np.zeros(capacity + 1), []
        for _ in range(capacity // int(sizes.min())):
            more = value[rest] + gain
            best = more.argmax(axis=1)
            more = more[room, best]
            better = more > value + 1e-12
            if not better.any():
                break
            picks.append(np.where(better, best, -1))
            value = np.where(better, more, value)
        if value[capacity] <= 1 + 1e-6:
            break
        column, c = np.zeros(m), capacity
        for pick in reversed(picks):
            if pick[c] >= 0:
                column[pick[c]] += 1
                c -= sizes[pick[c]]
        x, step = np.linalg.solve(basis, demand), np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-9, np.maximum(x, 0) / np.maximum(step, 1e-9), np.inf)
        if not np.isfinite(ratio).any():
            break
        basis[:, int(ratio.argmin())] = column
    x = np.linalg.solve(basis, demand)
    return [(basis[:, j].astype(int), float(x[j])) for j in range(m) if x[j] > 1e-9]


class Planner:
    """Places runs of equal lengths into runs of sequences that are filled alike.

    left and rank: by length, how many pieces have no place yet, and how many have one."""

    def __init__(self, histogram: np.ndarray, capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.left, self.rank = histogram.astype(np.int64), np.zeros(capacity + 1, dtype=np.int64)
        self.open: dict[int, list[tuple[int, int]]] = {}  # by room: (first sequence, number of them)
        self.rooms = np.zeros(capacity + 1, dtype=bool)
        self.runs: list[tuple[int, int, int, int, int, int]] = []  # length, rank from, rank to, number in a sequence, first sequence, offset
        self.carried: dict[int, int] = {}  # large pieces placed by configurations of so many pieces

    def add(self, room: int, first: int, n: int) -> None:
        if n and room:
            self.open.setdefault(room, []).append((first, n))
            self.rooms[room] = True

    def put(self, length: int, each: int, first: int, n: int, room: int) -> None:
        """each pieces of one length into each of n sequences with so much room."""
        rank = int(self.rank[length])
        self.runs.append((length, rank, rank + each * n, each, first, self.capacity - room))
        self.rank[length] += each * n
        self.left[length] -= each * n

    def best_fit(self, length: int) -> None:
        """All pieces of a length.  A sequence that took one is the tightest for the next, so it is filled first."""
        while n := int(self.left[length]):
            fits = np.flatnonzero(self.rooms[length:])
            if fits.size:
                room = length + int(fits[0])
                first, many = self.open[room].pop()
                if not self.open[room]:
                    del self.open[room]
                    self.rooms[room] = False
            else:
                room = self.capacity
                many = -(-n // (room // length))
                first, self.sequences = self.sequences, self.sequences + many
            each = min(room // length, n)
            used = min(many, n // each)
            self.put(length, each, first, used, room)
            self.add(room - each * length, first, used)
            self.add(room, first + used, many - used)

    def _choose(self, slots: list[tuple[int, int]], large: int) -> dict[int, int] | None:
        """Lengths for the slots of one sequence: the longest that is left of each group, and for the last slot the longest of all that fits."""
        room, chosen = self.capacity, {}
        for i, (low, top) in enumerate(slots):
            if i == len(slots) - 1:
                low, top = large, min(room, self.capacity - 1)
            some = np.flatnonzero(self.left[low + 1 : top + 1])[::-1] + low + 1
            length = next((int(x) for x in some if self.left[x] > chosen.get(int(x), 0)), None)
            if length is None:
                return None
            chosen[length] = chosen.get(length, 0) + 1
            room -= length
        return chosen

    def fill(self, slots: list[tuple[int, int]], times: int, large: int) -> None:
        """Substitute actual pieces in a configuration, so many times at most.  slots: bounds of the groups (low, top], longest first."""
        while times > 0 and (chosen := self._choose(slots, large)):
            many = min(times, *(int(self.left[x]) // each for x, each in chosen.items()))
            first, room = self.sequences, self.capacity
            self.sequences += many
            for length, each in sorted(chosen.items(), reverse=True):
                self.put(length, each, first, many, room)
                room -= each * length
            self.add(room, first, many)
            self.carried[len(slots)] = self.carried.get(len(slots), 0) + many * len(slots)
            times -= many


def plan(histogram: np.ndarray, *, capacity: int = CAPACITY, schemes: tuple[tuple[float, int], ...] = SCHEMES) -> np.ndarray:
    """Runs (length, rank from, rank to, number in a sequence, first sequence, offset) for histogram[length] pieces of each length.

    schemes: pairs of the share of the capacity above which a length counts as large, and the number of groups of
    equal cardinality; of the plans that linear grouping makes with them, the one with the fewest sequences stays."""
    found = min((grouped(histogram, capacity, share, groups) for share, groups in schemes), key=lambda p: p.sequences)
    return np.array(sorted(found.runs), dtype=np.int64).reshape(-1, 6)


def grouped(histogram: np.ndarray, capacity: int, share: float, groups: int) -> Planner:
    """The plan of linear grouping with one bound of what is large and one number of groups."""
    out, large = Planner(histogram, capacity), int(capacity * share)
    if n := int(out.left[capacity]):
        out.put(capacity, 1, 0, n, capacity)
        out.sequences = n
    lengths = np.flatnonzero(out.left[large + 1 : capacity])[::-1] + large + 1
    if lengths.size:
        counts = out.left[lengths]
        # all pieces of one length are in the group of the first of them
        group = (np.cumsum(counts) - counts) * groups // int(counts.sum())
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        tops, demand = lengths[starts], np.add.reduceat(counts, starts)
        lows = np.append(tops[1:], large)
        for config, times in sorted(configurations(tops, demand.astype(float), capacity), key=lambda x: -x[1]):
            out.fill([(int(lows[g]), int(tops[g])) for g in np.flatnonzero(config) for _ in range(config[g])], int(times + 1e-6), large)
    for length in range(capacity - 1, 0, -1):
        out.best_fit(length)
    return out


def place(pieces: DataFrame, runs: np.ndarray) -> DataFrame:
    """pieces (with rank: the rank among all of its length) with sequence_id and offset instead of rank."""
    key = (runs[:, 0] << 48) | runs[:, 1]
    names = [c for c in pieces.columns if c != "rank"]
    length_at, rank_at = pieces.columns.index("length"), pieces.columns.index("rank")
    kept = [pieces.columns.index(c) for c in names]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(length_at).to_numpy(), batch.column(rank_at).to_numpy()
            own = runs[np.searchsorted(key, (length << 48) | rank, side="right") - 1] if len(length) else np.zeros((0, 6), dtype=np.int64)
            i = rank - own[:, 1]
            each = np.maximum(own[:, 3], 1)
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in kept], pa.array(own[:, 4] + i // each), pa.array(own[:, 5] + i % each * length)], names=[*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes if c != "rank")
    return pieces.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    found = table(pieces(docs, tokenizer, capacity=capacity, end=end, id_col=id_col, text_col=text_col), "pieces")
    counts = found.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).drop("n")
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        histogram[r["length"]] = r["n"]
    runs = plan(histogram, capacity=capacity)
    ranked = found.join(before, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    return place(ranked, runs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    import public_tokenizers

    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
