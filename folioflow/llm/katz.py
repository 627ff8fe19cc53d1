"""Katz backoff language model over a whole corpus: bigrams with Good-Turing discounts.

Tokens are hashed words and one end for each document; the history of a first token is a start mark.
    P(w)     = d(c) c / N for known words; all unknown words together get what is left
    P(w | h) = d(c) c(h, w) / c(h) if h, w was seen, else alpha(h) P(w)
    alpha(h) = (1 - sum of P(w | h) over seen w) / (1 - sum of P(w) over seen w)
so that the probabilities of known words and of the unknown one sum to 1 after every history.  d is Katz's
Good-Turing discount for counts up to 5 and 1 - 1e-6 above.

Counts never become rows of single tokens.  Blocks of texts become arrays; their distinct words go to
buckets by hash, packed by block, where they are summed up and answered with an id and a count.  Then each block
sends its distinct bigrams to buckets of their history, with counts and with the documents they occur
in.  The bucket has all bigrams of its histories: it sums the counts up and sends back sums per document.
Very frequent histories (HOT of all tokens and more) are spread over all buckets by the second word; their
backoff weights are put together from the parts, at most 1 / HOT of them.  The word and bigram counts
stay as tables partitioned by bucket.  Ids and counts take 32 bits where they fit and 64 where they don't.

Defined results: null and empty texts have just the end token.  Without training texts every count is 0, and
unknown words have probability 1.  Repeated rows are scored alike.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as T
from ._shared import release, table

#: The hash of the end token, and the id of the start mark; words have ids from 1 on.
END, START = np.uint64(1), 0
#: Bits that ids may have to be sorted as pairs in one 64-bit number; pairs of longer ones are renumbered first.
PAIR_BITS = 32
#: Bytes of text in a block; bytes of text for each bucket.
BLOCK_BYTES, BUCKET_BYTES = 8 << 20, 20 << 20
#: Counts up to this are discounted by Good-Turing.
TOP = 5
HOT = 1 / 1000


def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _unpack(x: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype=kind)


def _pack_ints(x: np.ndarray) -> bytes:
    """Whole numbers from 0 on, as 32-bit ones if all are small enough, else as 64-bit ones."""
    kind = np.uint32 if not x.size or int(x.max()) < 1 << 32 else np.uint64
    return bytes([kind().itemsize]) + _pack(x.astype(kind))


def _unpack_ints(x: bytes) -> np.ndarray:
    return _unpack(x[1:], np.uint64 if x[0] == 8 else np.uint32)


def distinct_pairs(a: np.ndarray, b: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of a and b in order; for each its first place, and for each place its pair.

    Numbers of more than so many bits are replaced by their ranks first, of which there are fewer than 2^32."""
    if a.size and max(int(a.max()), int(b.max())) >> bits:
        (many_a, a), (many_b, b) = np.unique(a, return_inverse=True), np.unique(b, return_inverse=True)
        if max(many_a.size, many_b.size) >> 32:
            raise OverflowError("a bucket holds more than 2^32 ids")
        a, b, first, index = distinct_pairs(a, b, 32)
        return many_a[a], many_b[b], first, index
    both = a.astype(np.uint64) << np.uint64(32)
    both |= b.astype(np.uint64)
    both, first, index = np.unique(both, return_index=True, return_inverse=True)
    return (both >> np.uint64(32)).astype(np.uint32), both.astype(np.uint32), first, index


def _bucket(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of each hashed word: its highest bits."""
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(keys.size, dtype=np.int64)


def discounts(n: np.ndarray) -> np.ndarray:
    """d by count, from 0 to TOP + 1 (and above), for n[r] types of count r (r up to TOP + 1).

    Where Katz's formula gives nothing between 0 and 1 (few data), half a count is taken off."""
    d = np.ones(TOP + 2)
    d[TOP + 1] = 1 - 1e-6
    common = (TOP + 1) * n[TOP + 1] / n[1] if n[1] else np.nan
    for r in range(1, TOP + 1):
        turing = (r + 1) * n[r + 1] / (n[r] * r) if n[r] else np.nan
        value = (turing - common) / (1 - common) if common != 1 else np.nan
        d[r] = value if 0 < value < 1 else 1 - 0.5 / r
    return d


@dataclass
class Unigrams:
    """total: training tokens.  types: distinct ones.  n: types by count, up to TOP + 1."""

    total: int
    types: int
    n: np.ndarray

    def log_p(self, c: np.ndarray) -> np.ndarray:
        """log10 of P(w) for words of count c, 0 for the unknown one."""
        if not self.total:
            return np.zeros(c.shape)
        d = discounts(self.n)
        known = sum(d[r] * r * self.n[r] for r in range(1, TOP + 1)) / self.total
        above = (self.total - sum(r * self.n[r] for r in range(1, TOP + 1))) / self.total
        unknown = 1 - known - d[TOP + 1] * above
        p = d[np.minimum(c, TOP + 1)] * c / self.total
        return np.log10(np.where(c > 0, p, unknown))


def blocks(docs: DataFrame, bits: int) -> DataFrame:
    """docs (doc_id, train, text) as blocks: words by falling frequency, their buckets, and the texts as streams of their indices."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held, size
            keys, index = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True)
            counts = np.bincount(index, minlength=keys.size)
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(keys.size, dtype=np.uint32)
            rank[order] = np.arange(keys.size)
            stream, lengths, train = rank[index], np.concatenate([h[3] for h in held]), np.concatenate([h[1] for h in held])
            seen = np.bincount(stream[np.repeat(train, lengths)], minlength=keys.size)
            ids = pa.concat_arrays([h[0] for h in held])
            row = [number, keys.size, _pack(keys[order]), _pack(_bucket(keys[order], bits).astype(np.uint32)), _pack(seen.astype(np.uint32)), _pack(stream), _pack(lengths.astype(np.uint32)), _pack(train)]
            number, held, size = number + 1, [], 0
            kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 6]
            return pa.RecordBatch.from_arrays([*[pa.array([x], k) for x, k in zip(row, kinds, strict=True)], pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)], names=["block", "words", "keys", "buckets", "seen", "stream", "lengths", "train", "doc_ids"])

        for batch in batches:
            train = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for part in T.parts(batch.column(2)):
                data = T.LOWER[part.data]
                words = T.find_words(data, part.offsets, T.SPACED)
                first = words.first
                tokens = np.full(words.starts.size + part.rows, END, dtype=np.uint64)
                tokens[np.arange(words.starts.size) + words.rows] = np.maximum(T.hash_words(data, words, T.SPACED), np.uint64(2))
                held.append((batch.column(0).slice(part.lo, part.rows), train[part.lo : part.hi], tokens, np.diff(first) + 1))
                size += part.data.size + 8 * part.rows
                if size >= BLOCK_BYTES:
                    yield flush()
        if held:
            yield flush()

    return docs.mapInArrow(run, "block long, words long, keys binary, buckets binary, seen binary, stream binary, lengths binary, train binary, doc_ids array<long>")


def _word_buckets(stored: DataFrame, bits: int) -> DataFrame:
    """Sum the blocks' words up by bucket.  Rows with block -1 are the table of word counts; the others answer a block's
    words of that bucket, in the block's order, with ids and counts.  An id is place in bucket * buckets + bucket + 1."""

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, seen = _unpack(packed, np.uint64), _unpack(seen, np.uint32)
                bucket = _bucket(keys, bits)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))
                found = [(b, lo, hi) for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])) if hi > lo]
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _, _ in found], pa.int32()), pa.array([block] * len(found), pa.int64()), pa.array([keys[order[lo:hi]].tobytes() for _, lo, hi in found], pa.binary()), pa.array([_pack(seen[order[lo:hi]]) for _, lo, hi in found], pa.binary())], names=["bucket", "block", "keys", "seen"])

    def add(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        keys = [np.frombuffer(k.as_buffer(), np.uint64) for k in rows.column("keys")]
        seen = np.concatenate([_unpack(s.as_py(), np.uint32) for s in rows.column("seen")])
        distinct, index = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(index, seen, minlength=distinct.size).astype(np.int64)
        order = np.argsort(-total, kind="stable")
        place = np.empty(distinct.size, dtype=np.int64)
        place[order] = np.arange(distinct.size)
        word, cuts = place[index] * (1 << bits) + bucket + 1, np.cumsum([0, *(k.size for k in keys)])
        answers = [(_pack_ints(word[lo:hi]), _pack_ints(total[index[lo:hi]])) for lo, hi in zip(cuts, cuts[1:])]
        known = total[total > 0]
        n = np.bincount(np.minimum(known, TOP + 2), minlength=TOP + 3)[: TOP + 2]
        m = len(answers)
        hot = np.flatnonzero(total > 0)
        hot = hot[np.argsort(-total[hot], kind="stable")][: int(1 / HOT)]
        return pa.table({
            "bucket": pa.array([bucket] * (m + 1), pa.int32()), "block": pa.array([*rows.column("block").to_pylist(), -1], pa.int64()),
            "words": pa.array([*[a for a, _ in answers], _pack(distinct[order])], pa.binary()), "counts": pa.array([*[c for _, c in answers], _pack(total[order])], pa.binary()),
            "n": pa.array([*[None] * m, n.tolist()], pa.list_(pa.int64())), "total": pa.array([*[None] * m, int(total.sum())], pa.int64()), "types": pa.array([*[None] * m, known.size], pa.int64()),
            "top": pa.array([*[None] * m, (place[hot] * (1 << bits) + bucket + 1).tolist()], pa.list_(pa.int64())), "top_counts": pa.array([*[None] * m, total[hot].tolist()], pa.list_(pa.int64())),
        })

    dealt = stored.select("block", "keys", "seen").mapInArrow(deal, "bucket int, block long, keys binary, seen binary")
    return dealt.groupBy("bucket").applyInArrow(add, "bucket int, block long, words binary, counts binary, n array<long>, total long, types long, top array<long>, top_counts array<long>")


def _answered(stored: DataFrame, answers: DataFrame, bits: int, uni: Unigrams, hot: np.ndarray) -> DataFrame:
    """Blocks with their words' ids and counts: the base figures of each document (bucket -1), and the bigrams for each bucket."""
    size = 1 << bits
    scale = np.log10(uni.total + 0.5 * (uni.types + 1))
    names = ["block", "bucket", "seconds", "counts", "runs", "histories", "times", "docs", "doc_ids", "train", "base"]
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 6, pa.list_(pa.int64()), pa.binary(), pa.binary()]

    def run(key: tuple, block: pa.Table, given: pa.Table) -> pa.Table:
        number, n = key[0].as_py(), block.column("words")[0].as_py()
        bucket = _unpack(block.column("buckets")[0].as_py(), np.uint32)
        place, word, count = np.argsort(bucket, kind="stable"), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        cuts = np.searchsorted(bucket[place], np.arange(size + 1))
        for b, w, c in zip(given.column("bucket").to_pylist(), given.column("words").to_pylist(), given.column("counts").to_pylist(), strict=True):
            word[place[cuts[b] : cuts[b + 1]]], count[place[cuts[b] : cuts[b + 1]]] = _unpack_ints(w), _unpack_ints(c)
        stream, lengths, train = (_unpack(block.column(c)[0].as_py(), k) for c, k in (("stream", np.uint32), ("lengths", np.uint32), ("train", np.bool_)))
        ends = np.cumsum(lengths, dtype=np.int64)
        first = ends - lengths
        base = np.log10(count + 0.5) - scale
        figures = np.stack((lengths.astype(np.float64), np.add.reduceat((count > 0)[stream].astype(np.int64), first), np.add.reduceat(base[stream], first)))
        rows: list[list] = [[number, -1, *[None] * 6, block.column("doc_ids")[0].as_py(), _pack(train), _pack(figures)]]
        # bigrams of block-wide indices; n is the start mark
        before = np.empty(stream.size, dtype=np.int64)
        before[1:], before[first] = stream[:-1], n
        doc = np.repeat(np.arange(lengths.size, dtype=np.int64), lengths)
        both = before * (n + 1) + stream
        order = np.argsort(both, kind="stable")
        both, doc = both[order], doc[order]
        start = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
        times = np.diff(np.append(start, both.size))
        h, w = both[start] // (n + 1), both[start] % (n + 1)
        history = np.append(word, START)[h]
        second, c2 = word[w], count[w]
        spread = T.mix64(history.astype(np.uint64))
        hot_ones = np.isin(history, hot)
        spread[hot_ones] = T.mix64(spread[hot_ones] ^ second[hot_ones].astype(np.uint64))
        to = (spread & np.uint64(size - 1)).astype(np.int64)
        order = np.lexsort((history, second, to))
        # the documents in the new order of their bigrams
        begins = np.concatenate(([0], np.cumsum(times[order])))
        where = np.repeat(start[order] - begins[:-1], times[order]) + np.arange(both.size)
        doc, to, history, second, c2, times = doc[where], to[order], history[order], second[order], c2[order], times[order]
        cuts, narrow, flags = np.searchsorted(to, np.arange(size + 1)), np.uint16 if lengths.size <= 1 << 16 else np.uint32, _pack(train)
        for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            if hi > lo:
                # second words in order, with their counts and how many histories each has here
                runs = np.flatnonzero(np.concatenate(([True], second[lo + 1 : hi] != second[lo : hi - 1])))
                columns = (np.diff(second[lo:hi][runs], prepend=0), c2[lo:hi][runs], np.diff(np.append(runs, hi - lo)), history[lo:hi], times[lo:hi], doc[begins[lo] : begins[hi]])
                rows.append([number, b, *map(_pack_ints, columns[:5]), _pack(columns[5].astype(narrow)), None, flags, None])
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    schema = "block long, bucket int, seconds binary, counts binary, runs binary, histories binary, times binary, docs binary, doc_ids array<long>, train binary, base binary"
    return stored.drop("keys", "seen").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def _history_sums(history: np.ndarray, c12: np.ndarray, p2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the histories of sorted distinct bigrams: where each history begins; by history, types of count 1 to TOP, the sum of larger counts, the sum of P(w) of seen words and the sum of counts."""
    start = np.flatnonzero(np.concatenate(([True], history[1:] != history[:-1])))
    sums = [np.add.reduceat((c12 == r).astype(np.float64), start) for r in range(1, TOP + 1)]
    sums += [np.add.reduceat(np.where(c12 > TOP, c12, 0).astype(np.float64), start), np.add.reduceat(np.where(c12 > 0, p2, 0.0), start), np.add.reduceat(c12.astype(np.float64), start)]
    return start, history[start].astype(np.int64), np.stack(sums, axis=1)


def _bigram_buckets(pieces: DataFrame, uni: Unigrams, hot: np.ndarray, hot_counts: np.ndarray) -> DataFrame:
    """Sum bigrams up by bucket.  Rows: for each block, by document, the fixed parts of its score and how often a seen
    bigram of count 1 to TOP occurs, and its unseen bigrams as pairs of document and history; for the bucket (block -1) the table of
    bigram counts, the number of types by count, and the sums of the histories that unseen bigrams have."""
    names = ["bucket", "block", "touched", "fixed", "low", "unseen_docs", "unseen_histories", "histories", "sums", "bigram_histories", "bigram_seconds", "bigram_counts", "n"]
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 10, pa.list_(pa.int64())]

    def add(rows: pa.Table) -> pa.Table:
        columns = {c: [_unpack_ints(x) for x in rows.column(c).to_pylist()] for c in ("seconds", "counts", "runs", "histories", "times")}
        flags = [_unpack(x, np.bool_) for x in rows.column("train").to_pylist()]
        places = [_unpack(x, np.uint16 if f.size <= 1 << 16 else np.uint32).astype(np.int64) for x, f in zip(rows.column("docs").to_pylist(), flags, strict=True)]
        sizes = [x.size for x in columns["histories"]]
        runs = np.concatenate(columns["runs"])
        seconds = np.repeat(np.concatenate([np.cumsum(x, dtype=x.dtype) for x in columns["seconds"]]), runs)
        before, after, first, index = distinct_pairs(np.concatenate(columns["histories"]), seconds, PAIR_BITS)
        del seconds
        seen = [np.add.reduceat(f[p].astype(np.int64), np.cumsum(t, dtype=np.int64) - t) for f, p, t in zip(flags, places, columns["times"], strict=True)]
        c12 = np.bincount(index, np.concatenate(seen), minlength=before.size).astype(np.int64)
        log_p2 = uni.log_p(np.repeat(np.concatenate(columns["counts"]), runs)[first].astype(np.int64))
        start, history, sums = _history_sums(before, c12, 10**log_p2)
        c1 = sums[:, -1].copy()
        at = np.searchsorted(hot, history)
        is_hot = np.isin(history, hot)
        c1[is_hot] = hot_counts[at[is_hot]]
        of = np.repeat(np.arange(history.size), np.diff(np.append(start, before.size)))
        fixed = np.where(c12 > 0, np.log10(np.maximum(c12, 1)) - np.log10(np.maximum(c1, 1))[of], log_p2)
        level = np.where(c12 > TOP, TOP + 1, c12)
        out, wanted, lo = [], np.zeros(history.size, dtype=bool), 0
        bucket = rows.column("bucket")[0].as_py()
        for block, size, times, docs in zip(rows.column("block").to_pylist(), sizes, columns["times"], places, strict=True):
            each = np.repeat(index[lo : lo + size], times)
            lo += size
            n = int(docs.max()) + 1
            sum_fixed, low = np.bincount(docs, fixed[each], minlength=n), np.zeros((TOP + 1, n), dtype=np.int64)
            for r in range(1, TOP + 2):
                low[r - 1] = np.bincount(docs[level[each] == r], minlength=n)
            touched = np.flatnonzero(np.bincount(docs, minlength=n))
            new = c12[each] == 0
            wanted[of[each[new]]] = True
            out.append([bucket, block, _pack(touched.astype(np.uint32)), sum_fixed[touched].tobytes(), _pack(low[:, touched].astype(np.uint32)), _pack(docs[new].astype(np.uint32)), _pack_ints(history[of[each[new]]]), None, None, None, None, None, None])
        wanted |= is_hot
        n = np.bincount(np.minimum(c12, TOP + 2), minlength=TOP + 3)[: TOP + 2]
        known = c12 > 0
        out.append([bucket, -1, *[None] * 5, _pack_ints(history[wanted]), _pack(sums[wanted]), _pack_ints(before[known]), _pack_ints(after[known]), _pack_ints(c12[known]), n.tolist()])
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    schema = "bucket int, block long, touched binary, fixed binary, low binary, unseen_docs binary, unseen_histories binary, histories binary, sums binary, bigram_histories binary, bigram_seconds binary, bigram_counts binary, n array<long>"
    return pieces.groupBy("bucket").applyInArrow(add, schema)


def backoff(sums: np.ndarray, counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    """log10 alpha of histories with these sums (see _history_sums) and counts; 0 for those without any."""
    discounted = sums[:, :TOP] @ (d[1 : TOP + 1] * np.arange(1, TOP + 1)) + d[TOP + 1] * sums[:, TOP]
    left = np.where(counts > 0, 1 - discounted / np.maximum(counts, 1), 1.0)
    rest = np.where(counts > 0, 1 - sums[:, TOP + 1], 1.0)
    return np.log10(np.maximum(left, 1e-12)) - np.log10(np.maximum(rest, 1e-12))


def score(docs: DataFrame, train: Column, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of docs: doc_id, train, n_tokens, n_known, train_tokens, base_score, score; the model is that of the rows where train holds."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 8).alias("bytes"), F.sum(F.col("train").cast("int")).alias("train")).first()
    bits = int(np.ceil(np.log2(max((size["bytes"] or 0) / BUCKET_BYTES, 1))))
    stored = table(blocks(docs, bits), "lm-blocks")
    words = table(_word_buckets(stored, bits), "lm-words", "bucket")
    uni, hot, hot_counts = _summary(words.where("block = -1"), size["train"] or 0)
    answers = words.where("block <> -1").select("block", "bucket", "words", "counts")
    dealt = table(_answered(stored, answers, bits, uni, hot).withColumn("kind", F.when(F.col("bucket") == -1, "base").otherwise("pieces")), "lm-pieces", "kind")
    release(stored)
    pieces = dealt.where("kind = 'pieces'").drop("kind", "doc_ids", "base")
    sums = table(_bigram_buckets(pieces, uni, hot, hot_counts), "lm-bigrams", "bucket")
    release(dealt, "kind=pieces")
    own = sums.where("block = -1")
    n = np.zeros(TOP + 2)
    for r in own.select(F.posexplode("n").alias("r", "n")).groupBy("r").agg(F.sum("n").alias("n")).collect():  # TOP + 2 rows
        n[r["r"]] = r["n"]
    d = discounts(n)
    hot_alpha = _hot_weights(own, hot, hot_counts, d)
    parts = _settled(sums.select("bucket", "block", "touched", "fixed", "low", "unseen_docs", "unseen_histories", "histories", "sums"), hot, hot_alpha, d)
    return _documents(dealt.where("kind = 'base'").select("block", "doc_ids", "train", "base"), parts, uni)


def _summary(own: DataFrame, starts: int) -> tuple[Unigrams, np.ndarray, np.ndarray]:
    """Figures of the words, and the ids of very frequent histories in order, with their counts; the start mark is one."""
    sums = own.agg(F.sum("total").alias("total"), F.sum("types").alias("types"), *[F.sum(F.col("n")[r]).alias(f"n{r}") for r in range(TOP + 2)]).first()
    uni = Unigrams(sums["total"] or 0, sums["types"] or 0, np.array([float(sums[f"n{r}"] or 0) for r in range(TOP + 2)]))
    top = own.select(F.explode(F.arrays_zip("top", "top_counts")).alias("t")).select("t.top", "t.top_counts").where(F.col("top_counts") >= max(uni.total * HOT, 1))
    rows = [(START, starts), *sorted((r["top"], r["top_counts"]) for r in top.collect())]  # at most 1 / HOT words can be so frequent
    return uni, np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=np.int64)


def _hot_weights(own: DataFrame, hot: np.ndarray, counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    """log10 alpha of the very frequent histories, from their parts in all buckets."""
    def take(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((hot.size, TOP + 3))
        for batch in batches:
            for h, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = _unpack_ints(h).astype(np.int64)
                found = np.isin(h, hot)
                np.add.at(total, np.searchsorted(hot, h[found]), _unpack(s, np.float64).reshape(-1, TOP + 3)[found])
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in [total]], pa.binary())], names=["sums"])

    def add(rows: pa.Table) -> pa.Table:
        return pa.table({"part": rows.column("part")[:1], "sums": pa.array([sum(np.frombuffer(x, np.float64) for x in rows.column("sums").to_pylist()).tobytes()], pa.binary())})

    parts = own.select("histories", "sums").mapInArrow(take, "sums binary").withColumn("part", F.spark_partition_id() % 16).select("part", "sums")
    found = parts.groupBy("part").applyInArrow(add, "part int, sums binary").collect()  # at most 16 rows
    total = sum((np.frombuffer(r["sums"], np.float64) for r in found), np.zeros(hot.size * (TOP + 3))).reshape(hot.size, TOP + 3)
    return backoff(total, counts.astype(np.float64), d)


def _settled(sums: DataFrame, hot: np.ndarray, hot_alpha: np.ndarray, d: np.ndarray) -> DataFrame:
    """By block and bucket: the documents touched and the parts of their scores."""
    log_d = np.log10(d[1:])

    def run(rows: pa.Table) -> pa.Table:
        own = rows.filter(pa.compute.equal(rows.column("block"), -1))
        known = _unpack_ints(own.column("histories")[0].as_py()).astype(np.int64)
        figures = _unpack(own.column("sums")[0].as_py(), np.float64).reshape(-1, TOP + 3)
        alpha = backoff(figures, figures[:, -1], d)
        if known.size:
            at = np.minimum(np.searchsorted(hot, known), hot.size - 1)
            alpha = np.where(hot[at] == known, hot_alpha[at], alpha)
        out = []
        for block, touched, fixed, low, docs, histories in zip(*(rows.column(c).to_pylist() for c in ("block", "touched", "fixed", "low", "unseen_docs", "unseen_histories")), strict=True):
            if block == -1:
                continue
            touched, docs = _unpack(touched, np.uint32).astype(np.int64), _unpack(docs, np.uint32).astype(np.int64)
            part = np.frombuffer(fixed, np.float64) + log_d @ _unpack(low, np.uint32).reshape(TOP + 1, -1)
            if docs.size:
                weights = alpha[np.searchsorted(known, _unpack_ints(histories).astype(np.int64))]
                part = part + np.bincount(docs, weights, minlength=int(touched.max()) + 1)[touched]
            out.append((block, touched.astype(np.uint32).tobytes(), part.tobytes()))
        return pa.table([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], names=["block", "touched", "part"])

    return sums.groupBy("bucket").applyInArrow(run, "block long, touched binary, part binary")


def _documents(infos: DataFrame, parts: DataFrame, uni: Unigrams) -> DataFrame:
    """Scores of the documents of each block, from the parts of all buckets."""

    def run(key: tuple, info: pa.Table, own: pa.Table) -> pa.Table:
        ids = info.column("doc_ids").chunk(0).flatten() if info.column("doc_ids").num_chunks == 1 else pa.concat_arrays([c.flatten() for c in info.column("doc_ids").chunks])
        figures, train = _unpack(info.column("base")[0].as_py(), np.float64).reshape(3, -1), _unpack(info.column("train")[0].as_py(), np.bool_)
        total = np.zeros(figures.shape[1])
        for touched, part in sorted(zip(own.column("touched").to_pylist(), own.column("part").to_pylist(), strict=True)):
            total[np.frombuffer(touched, np.uint32)] += np.frombuffer(part, np.float64)
        n = len(ids)
        return pa.table({"doc_id": ids, "train": train, "n_tokens": figures[0].astype(np.int64), "n_known": figures[1].astype(np.int64), "train_tokens": np.full(n, uni.total, dtype=np.int64), "base_score": figures[2], "score": total})

    schema = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return infos.groupBy("block").cogroup(parts.groupBy("block")).applyInArrow(run, schema)


def held_out(id_col: str | Column = "doc_id") -> Column:
    return T.fold(id_col, mod=5) == 1


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under the model of those outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = score(docs, ~held_out())
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
