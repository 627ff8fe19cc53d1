"""Licence scan: fuzzy search for short notices.

Words are runs of ASCII letters (lower-cased), digits and multi-byte characters; a text is searched as
its words joined by single spaces.  A notice of m characters may have k errors; it is cut into k + 1
pieces, of which at least one must occur unchanged (pigeonhole), so exact hits of the pieces locate all
candidates.  The regex library's bounded-error matching then verifies the edits around each hit, and
the operator reports the spans.  Words that tell licences apart (mit, nc, 2) may have no error.  Where matches overlap, the one with the fewest errors stays (then the
longest, then the first label).  Phrases that stand word by word are the base places; they are counted
apart and their labels always stay.

Defined results: null and empty texts have no words, no places, empty labels and score 0.  The score is
1 for an exact phrase, else the largest share of unchanged characters of any match, else 0.  Errors
count bytes of UTF-8.  Extra columns pass through; input columns named like the results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from . import _text as T

# Phrases of the base labels.
BASE = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

# Notices that are searched with errors: label, words, most errors.  Words in braces tell licences
# apart and may have no error; a notice with a fourth value does not count where a word of that pattern follows.
NOTICES = [
    ("mit", "released under the {mit} license", 3),
    ("mit", "licensed under the {mit} license", 3),
    ("mit", "under the {mit} license", 2),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    ("apache-2", "apache license version {2}", 2),
    ("apache-2", "apache license version {20}", 2),
    ("cc-by", "licensed under {cc by}", 2, "[a-z]{2}"),
    ("cc-by-nc", "licensed under {cc by nc}", 2, "[a-z]{2}"),
    ("cc-by-nd", "licensed under {cc by nd}", 2),
    ("cc-by-sa", "licensed under {cc by sa}", 2),
    ("cc-by-nc-nd", "licensed under {cc by nc nd}", 2),
    ("cc-by-nc-sa", "licensed under {cc by nc sa}", 2),
    ("cc0", "creative commons {zero} universal", 3),
    ("gpl", "{gnu} general public license", 3),
    ("lgpl", "{gnu lesser} general public license", 3),
    ("agpl", "{gnu affero} general public license", 3),
    ("mpl-2", "mozilla public license version {2}", 3),
    ("mpl-2", "mozilla public license version {20}", 3),
    ("epl", "{eclipse} public license", 2),
    ("bsd", "under the {bsd} license", 2),
    ("bsd", "redistribution and use in source and binary forms", 4),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", 6),
    ("unlicense", "free and unencumbered software released into the public domain", 5),
    ("all-rights-reserved", "all rights {reserved}", 2),
]

SPAN = StructType([StructField("label", StringType()), StructField("first_word", LongType()), StructField("last_word", LongType()), StructField("errors", IntegerType()), StructField("text", StringType())])
RESULT = [
    StructField("n_words", LongType(), False), StructField("n_base", LongType(), False), StructField("first_word", LongType()), StructField("last_word", LongType()),
    StructField("base_labels", StringType(), False), StructField("labels", StringType(), False), StructField("score", DoubleType(), False), StructField("spans", ArrayType(SPAN), False),
]
_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("errors", pa.int32()), ("text", pa.string())]))]


@dataclass(frozen=True)
class Notice:
    """marked: the words, with those that may have no error in braces.  unless: a pattern of the word that may not follow."""

    label: str
    marked: str
    errors: int
    unless: str = ""

    @cached_property
    def words(self) -> str:
        return self.marked.replace("{", "").replace("}", "")

    @cached_property
    def pieces(self) -> list[tuple[int, bytes]]:
        """k + 1 pieces of nearly equal length, and where each begins."""
        raw, n = self.words.encode(), self.errors + 1
        cuts = [len(raw) * i // n for i in range(n + 1)]
        return [(cuts[i], raw[cuts[i] : cuts[i + 1]]) for i in range(n)]

    @cached_property
    def pattern(self):
        """The words between the braces as whole words without errors, what is around them with errors."""
        out = []
        for i, part in enumerate(regex.split("[{}]", self.marked)):
            if part:
                raw = regex.escape(part, special_only=True)
                out.append(f"(?<=[ \\n]){raw}(?=[ \\n])" if i % 2 else f"(?:{raw}){{e<={self.errors}}}")
        unless = f"(?! (?:{self.unless})[ \\n])" if self.unless else ""
        return regex.compile(f"(?be)(?<=[ \\n]){''.join(out)}(?=[ \\n]){unless}".encode())

    def search(self, text: bytes, lo: int, hi: int) -> tuple[int, int, int] | None:
        """Start, end and errors of the best match that lies in a part of a text."""
        m = self.pattern.search(text, lo, hi)
        if m is None or sum(m.fuzzy_counts) > self.errors or b"\n" in m[0]:
            return None
        return m.start(), m.end(), sum(m.fuzzy_counts)


def normalise(part: T.Part) -> tuple[bytes, np.ndarray, T.Words]:
    """The part's words: each row is a line feed and then a space before each word, and a last line feed ends all.

    Also where each word begins there."""
    data = T.LOWER[part.data]
    words = T.find_words(data, part.offsets, T.ALNUM)
    rows, size, n = words.rows, words.ends - words.starts, words.starts.size
    out = np.full(int(size.sum()) + n + part.rows + 1, 32, dtype=np.uint8)
    shift = np.arange(1, n + 1) + rows + 1
    began = np.cumsum(size) - size + shift
    if n:
        out[np.arange(int(size.sum())) + np.repeat(shift, size)] = data[T.ALNUM[data]]
    first = words.first
    line = np.append(began, out.size)[first[:-1]] - 2
    tail = np.concatenate((line[1:], [out.size - 1]))
    for i in np.flatnonzero(words.counts == 0)[::-1]:  # rows without words are a line feed before the next row's
        line[i] = (line[i + 1] if i + 1 < part.rows else tail[-1]) - 1
    out[line] = out[-1] = 10
    return out.tobytes(), began, words


def places(text: bytes, found: bytes) -> list[int]:
    out, at = [], text.find(found)
    while at >= 0:
        out.append(at)
        at = text.find(found, at + 1)
    return out


def fuzzy(text: bytes, notices: list[Notice]) -> list[tuple[int, int, int, Notice]]:
    """Verified matches (start, end, errors, notice) in a normalised text, without those that a better one overlaps."""
    found = set()
    hits: dict[bytes, list[int]] = {}
    for notice in notices:
        size, k, margin = len(notice.words), notice.errors, 4 if notice.unless else 0  # the word that may not follow, and its end
        windows = set()
        for offset, piece in notice.pieces:
            if piece not in hits:
                hits[piece] = places(text, piece)
            windows |= {(max(at - offset - k - 1, 0), at - offset + size + k + 1 + margin) for at in hits[piece]}
        for lo, hi in windows:
            m = notice.search(text, lo, min(hi, len(text)))
            if m:
                found.add((*m, notice))
    kept: list[tuple[int, int, int, Notice]] = []
    for x in sorted(found, key=lambda x: (x[2], x[0] - x[1], x[3].label, x[0])):
        if all(x[1] <= y[0] or x[0] >= y[1] for y in kept):
            kept.append(x)
    return sorted(kept, key=lambda x: x[0])


def scan_part(part: T.Part, base: dict[str, str], notices: list[Notice]) -> list[list]:
    """The values of each RESULT column for the rows of a part."""
    text, began, words = normalise(part)
    first = words.first
    bases: dict[int, list[tuple[int, str]]] = {}
    for label, phrase in base.items():
        sought = b" " + phrase.encode()
        for at in places(text, sought):
            if text[at + len(sought)] in b" \n":
                word = int(np.searchsorted(began, at + 1))
                row = int(np.searchsorted(first, word, side="right")) - 1
                bases.setdefault(row, []).append((word - int(first[row]), label))
    spans: dict[int, list[dict]] = {}
    best = np.zeros(part.rows)
    # a seed that occurs nowhere in the part costs one search; rows are verified one line at a time
    touched = sorted({int(np.searchsorted(began, at, side="right")) for n in notices for _, piece in n.pieces for at in places(text, piece)})
    rows = sorted({int(np.searchsorted(first, max(w - 1, 0), side="right")) - 1 for w in touched})
    for row in rows:
        if not words.counts[row]:
            continue
        lo = int(began[first[row]]) - 2
        hi = text.index(b"\n", lo + 1) + 1
        for s, e, errors, notice in fuzzy(text[lo:hi], notices):
            a = int(np.searchsorted(began, lo + s, side="right")) - 1 - int(first[row])
            b = int(np.searchsorted(began, lo + e - 1, side="right")) - 1 - int(first[row])
            spans.setdefault(row, []).append({"label": notice.label, "first_word": max(a, 0), "last_word": b, "errors": errors, "text": text[lo + s : lo + e].decode("utf-8", "replace").strip()})
            best[row] = max(best[row], 1 - errors / len(notice.words))
    out: list[list] = [[] for _ in RESULT]
    for row in range(part.rows):
        own = bases.get(row, ())
        labels = {x[1] for x in own}
        more = labels | {x["label"] for x in spans.get(row, ())}
        values = (int(words.counts[row]), len(own), min((x[0] for x in own), default=None), max((x[0] for x in own), default=None), ",".join(sorted(labels)), ",".join(sorted(more)), 1.0 if own else float(best[row]), spans.get(row, []))
        for column, value in zip(out, values, strict=True):
            column.append(value)
    return out


def scan(df: DataFrame, *, text_col: str = "text", base: dict[str, str] | None = None, notices: list[tuple] | None = None) -> DataFrame:
    """df with n_words, n_base, first_word, last_word, base_labels, labels, score and spans (label, words, errors, text)."""
    base = BASE if base is None else base
    table = [Notice(*n) for n in (NOTICES if notices is None else notices)]
    at = [c for c in df.columns if c not in {f.name for f in RESULT}].index(text_col)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        columns: list[list] = [[] for _ in RESULT]
        for part in T.parts(batch.column(at)):
            for column, more in zip(columns, scan_part(part, base, table), strict=True):
                column += more
        return [pa.array(c, t) for c, t in zip(columns, _ARROW, strict=True)]

    return T.append_columns(df, RESULT, compute)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels of all documents."""
    docs = T.spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return scan(docs).drop("text", "spans")
