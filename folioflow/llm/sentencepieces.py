"""SentencePiece encoding and decoding for merge-type vocabularies.

The encoder keeps an agenda of adjacent symbol pairs whose joint text is a piece, ordered by score and
then from left to right, and merges the best until none is left; characters without a piece become their
UTF-8 bytes.  As no piece has a space mark behind another character, a text falls into segments (space
marks, then other characters) that merge independently of each other.  Distinct new segments of an
Arrow batch are merged together: each round takes the best pair of every segment's agenda.  Long ones
have a heap of their own.  In each batch the sentencepiece library encodes every new segment, and one whole
text, again; a difference is an error.  Decoding is the library's.

Defined results: a null text is empty, and has just the end id.  Extra columns pass through; input columns
named like the results are replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from ._text import append_columns, spread

SPACE = "▁"
_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Segments of more characters have a heap of their own.
LONG = 200
#: Segments that a worker remembers, and texts that it handles at once.
REMEMBERED, TEXTS = 400_000, 256
_NONE = np.int64(1 << 40)


class Encoder:
    """Encodes texts as the model file's merges say, without any special ids."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        if spec.trainer_spec.model_type != 2 or not spec.trainer_spec.byte_fallback:
            raise ValueError("a merge-type vocabulary with bytes for unknown characters is needed")
        n = spec.normalizer_spec
        if n.precompiled_charsmap or not n.add_dummy_prefix or n.remove_extra_whitespaces or not n.escape_whitespaces or any(p.type in (4, 5) for p in spec.pieces):
            raise ValueError("only texts as they are, with a space put before, and normal pieces are supported")
        self.library = SentencePieceProcessor(model_file=path)
        normal = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == 1}
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("pieces with a space mark behind other characters are not supported")
        self.bytes = [0] * 256
        for i, p in enumerate(spec.pieces):
            if p.type == 6:
                self.bytes[int(p.piece[3:5], 16)] = i
        self.end = self.library.eos_id()
        order = {s: r for r, s in enumerate(sorted({spec.pieces[i].score for i in normal.values()}, reverse=True))}
        # symbols: pieces by id; then characters that only occur within pieces; unknown ones are -1 - code point
        symbols = dict(normal)
        for c in sorted({c for p in normal for c in p}):
            symbols.setdefault(c, len(spec.pieces) + len(symbols))
        self.n_pieces = len(spec.pieces)
        self.base = max(symbols.values()) + 1
        self.single = -1 - np.arange(0x110000, dtype=np.int64)
        for s, i in symbols.items():
            if len(s) == 1:
                self.single[ord(s)] = i
        self.inner = {i: ord(s) for s, i in symbols.items() if i >= self.n_pieces}
        pairs = sorted((symbols[p[:k]] * self.base + symbols[p[k:]], order[spec.pieces[i].score], i) for p, i in normal.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols)
        self.lookup = {k: (r, i) for k, r, i in pairs}
        self._fill(*(np.array(c, dtype=np.int64) for c in zip(*pairs, strict=True)))
        self.decimal = [b"%d " % i for i in range(self.n_pieces)]
        # by segment without its first space mark: its ids as 32-bit numbers
        self.known: dict[str, bytes] = {}

    def _fill(self, keys: np.ndarray, ranks: np.ndarray, merged: np.ndarray) -> None:
        """An open-addressed table of the pairs, at most a quarter full."""
        size = 1 << int(np.ceil(np.log2(4 * keys.size + 4)))
        self.mask = size - 1
        self.keys, self.ranks, self.merged = np.full(size, -1), np.full(size, _NONE), np.zeros(size, dtype=np.int64)
        left, at = np.arange(keys.size), self._slot(keys)
        while left.size:
            free = self.keys[at[left]] < 0
            placed = np.unique(at[left[free]], return_index=True)[1]
            placed = left[free][placed]
            self.keys[at[placed]], self.ranks[at[placed]], self.merged[at[placed]] = keys[placed], ranks[placed], merged[placed]
            left = left[~np.isin(left, placed)]
            at[left] = (at[left] + (self.keys[at[left]] >= 0)) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * 0x2545F4914F6CDD1D) >> 24) & self.mask

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of each pair of symbols; _NONE where there is none."""
        key = left * self.base + right
        at = self._slot(key)
        found = self.keys[at]
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while open_.size:
            at[open_] = (at[open_] + 1) & self.mask
            found = self.keys[at[open_]]
            open_ = open_[(found != key[open_]) & (found >= 0)]
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.ranks[at], _NONE), self.merged[at]

    def _ids(self, symbols: list[int]) -> list[int]:
        """Ids of symbols; bytes for characters without a piece."""
        if min(symbols) >= 0 and max(symbols) < self.n_pieces:
            return symbols
        out = []
        for s in symbols:
            if 0 <= s < self.n_pieces:
                out.append(s)
            else:
                out += [self.bytes[b] for b in chr(self.inner[s] if s >= 0 else -1 - s).encode()]
        return out

    def merge_one(self, segment: str) -> list[int]:
        """The agenda of one segment as a heap."""
        symbols = [int(self.single[ord(c)]) for c in segment]
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        agenda: list[tuple[int, int, int, int, int]] = []

        def propose(i: int) -> None:
            if 0 <= i and after[i] < len(symbols):
                a, b = symbols[i], symbols[after[i]]
                found = self.lookup.get(a * self.base + b) if a >= 0 and b >= 0 else None
                if found:
                    heapq.heappush(agenda, (found[0], i, a, b, found[1]))

        for i in range(len(symbols)):
            propose(i)
        gone = [False] * len(symbols)
        while agenda:
            _, i, a, b, new = heapq.heappop(agenda)
            j = after[i]
            if gone[i] or symbols[i] != a or j >= len(symbols) or symbols[j] != b:
                continue
            symbols[i], gone[j], after[i] = new, True, after[j]
            if after[i] < len(symbols):
                before[after[i]] = i
            propose(before[i])
            propose(i)
        return self._ids([s for s, g in zip(symbols, gone, strict=True) if not g])

    def merge(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The agendas of many segments, a round at a time: their ids, and where each segment's begin."""
        symbols = self.single[np.frombuffer("".join(segments).encode("utf-32-le"), dtype=np.uint32)]
        owner = np.repeat(np.arange(len(segments)), [len(s) for s in segments])
        n = symbols.size
        rank, new = np.full(n, _NONE), np.zeros(n, dtype=np.int64)
        rank[:-1], new[:-1] = self._pairs(symbols[:-1], symbols[1:])
        rank[:-1][owner[1:] != owner[:-1]] = _NONE
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while symbols.size:
            n = symbols.size
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            best = np.minimum.reduceat(np.minimum(rank, _NONE) * (n + 1) + np.arange(n), first)
            live = best < _NONE * (n + 1)
            if not live.all():
                keep = np.repeat(live, np.diff(np.append(first, n)))
                done.append((owner[~keep], symbols[~keep]))
                best = best[live] % (n + 1)
                best = np.cumsum(keep)[best] - 1
                symbols, owner, rank, new = symbols[keep], owner[keep], rank[keep], new[keep]
            else:
                best = best % (n + 1)
            if not symbols.size:
                break
            symbols[best] = new[best]
            keep = np.ones(symbols.size, dtype=bool)
            keep[best + 1] = False
            at = best - np.arange(best.size)  # one symbol goes for each merge before it
            symbols, owner, rank, new = symbols[keep], owner[keep], rank[keep], new[keep]
            for i in (at, at - 1):
                i = i[i >= 0]
                pair = i[(i + 1 < symbols.size)]
                rank[i] = _NONE
                r, m = self._pairs(symbols[pair], symbols[pair + 1])
                r[owner[pair] != owner[pair + 1]] = _NONE
                rank[pair], new[pair] = r, m
        owner = np.concatenate([o for o, _ in done]) if done else np.zeros(0, dtype=np.int64)
        flat = np.concatenate([s for _, s in done]) if done else owner
        order = np.argsort(owner, kind="stable")
        flat, cuts = flat[order], np.searchsorted(owner[order], np.arange(len(segments) + 1))
        if flat.size and (flat.min() < 0 or flat.max() >= self.n_pieces):
            odd = np.flatnonzero((flat < 0) | (flat >= self.n_pieces))
            ids = [self._ids([x]) for x in flat[odd].tolist()]
            size = np.ones(flat.size, dtype=np.int64)
            size[odd] = [len(x) for x in ids]
            cuts = np.concatenate(([0], np.cumsum(size)))[cuts]
            byte_ids = np.repeat(size > 1, size)
            single = np.flatnonzero(size[odd] == 1)
            flat[odd[single]] = [ids[i][0] for i in single]
            flat = np.repeat(flat, size)
            flat[byte_ids] = list(chain.from_iterable(x for x in ids if len(x) > 1))
        return flat, cuts

    def learn(self, segments: set[str]) -> None:
        """Merge new segments, given without their first space mark, check them against the library, and remember them."""
        new = [s for s in segments if s and len(s) < LONG]
        flat, cuts = self.merge([SPACE + s for s in new])
        theirs = self.library.encode([s.replace(SPACE, " ") for s in new] if any(SPACE in s for s in new) else new, num_threads=1)
        if list(chain.from_iterable(theirs)) != flat.tolist() or list(map(len, theirs)) != np.diff(cuts).tolist():
            raise ValueError(f"the library encodes a segment differently: {next(s for s, t, lo, hi in zip(new, theirs, cuts, cuts[1:]) if t != flat[lo:hi].tolist())!r}")
        raw, cuts = flat.astype("<u4").tobytes(), (4 * cuts).tolist()
        self.known.update(zip(new, map(raw.__getitem__, map(slice, cuts, cuts[1:]))))
        for s in segments:
            if not s or len(s) >= LONG:  # the library has no text of only the space that it puts before
                own = self.merge_one(SPACE + s)
                if s and own != self.library.encode(s.replace(SPACE, " ")):
                    raise ValueError(f"the library encodes a segment differently: {s[:200]!r}")
                self.known[s] = np.array(own, dtype="<u4").tobytes()

    @staticmethod
    def segments(text: str) -> list[str]:
        """The text's segments, each without its first space mark."""
        if not text:
            return []
        if SPACE not in text:
            cut = text.split(" ")
            if "" not in cut:
                return cut
        return [s[1:] for s in _SEGMENT.findall(SPACE + text.replace(" ", SPACE))]

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, list[int]]]:
        """For each text, its decimal ids with a space behind each, and its ids."""
        for lo in range(0, len(texts), TEXTS):
            cut = [self.segments(t) for t in texts[lo : lo + TEXTS]]
            wanted = set().union(*cut)
            if len(self.known) + len(wanted) > REMEMBERED:
                # short segments come again most often
                self.known = {s: ids for s, ids in self.known.items() if len(s) <= 8}
                if len(self.known) > REMEMBERED // 2:
                    self.known = {}
            new = wanted - self.known.keys()
            if new:
                self.learn(new)
            for segments in cut:
                ids = np.frombuffer(b"".join(map(self.known.__getitem__, segments)), dtype="<u4").tolist()
                yield b"".join(map(self.decimal.__getitem__, ids)), ids


@lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    return Encoder(path)


def process(df: DataFrame, model: str, *, text_col: str = "text", ids: bool = False, decoded: bool = False) -> DataFrame:
    """df with n_tokens, ids_sha256 and decoded_sha256, and the ids and the decoded text themselves if wanted."""
    fields = [StructField("n_tokens", LongType(), False), StructField("ids_sha256", StringType(), False), StructField("decoded_sha256", StringType(), False)]
    fields += [StructField("ids", ArrayType(IntegerType()), False)] * ids + [StructField("decoded", StringType(), False)] * decoded
    at = [c for c in df.columns if c not in {f.name for f in fields}].index(text_col)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        encoder = load(model)
        columns: list[list] = [[] for _ in fields]
        checked = False
        for lo in range(0, batch.num_rows, TEXTS):
            texts = [t or "" for t in batch.column(at).slice(lo, TEXTS).to_pylist()]
            encoded = list(encoder.encode(texts))
            all_ids = [i + [encoder.end] for _, i in encoded]
            if not checked and all_ids:
                if all_ids[0] != encoder.library.encode(texts[0], add_eos=True):
                    raise ValueError(f"the library encodes a text differently: {texts[0][:200]!r}")
                checked = True
            back = encoder.library.decode(all_ids, num_threads=1)
            end = b"%d" % encoder.end
            columns[0] += map(len, all_ids)
            columns[1] += [hashlib.sha256(raw + end).hexdigest() for raw, _ in encoded]
            columns[2] += [hashlib.sha256(t.encode()).hexdigest() for t in back]
            if ids:
                columns[3] += all_ids
            if decoded:
                columns[-1] += back
        kinds = [pa.int64(), pa.string(), pa.string(), *[pa.list_(pa.int32())] * ids, *[pa.string()] * decoded]
        return [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]

    return append_columns(df, fields, compute)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded texts of all documents, as hashes."""
    import public_tokenizers

    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return process(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")
