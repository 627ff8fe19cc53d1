"""DataFrame forms of the sequential span operators: one Arrow pass over documents, or one group per document."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from . import exam as E
from . import spans as S
from . import synthetic as G

SPANS = "array<struct<start:int,end:int,label:string>>"
#: Bytes of text that are Python objects at a time.
PART = 1 << 20


def _rows(spans: list[S.Span]) -> list[tuple[int, int, str]]:
    return [(s.start, s.end, s.label) for s in spans]


def parts(batch: pa.RecordBatch, columns: list[str], most: int = PART) -> Iterator[pa.RecordBatch]:
    """A batch in stretches of rows whose texts (columns of strings, or of lists of them) take about so many bytes; a longer row is one by itself.

    A batch has ever more rows as a table grows, and its texts as Python objects with all that is made of them take many times
    its bytes; so only one stretch at a time becomes Python objects."""
    size = np.zeros(batch.num_rows, dtype=np.int64)
    for c in columns:
        column = batch.column(c)
        if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
            lengths = pc.fill_null(pc.binary_length(column.flatten()), 0)
            np.add.at(size, pc.list_parent_indices(column).to_numpy(), lengths.to_numpy(zero_copy_only=False))
        else:
            size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right"))
        upto = max(at + 1, upto)
        yield batch.slice(at, upto - at)
        at = upto


def per_texts(df: DataFrame, texts: list[str], fields: str, f: Callable[..., dict]) -> DataFrame:
    """df without its texts, and with the fields that f gives for them; null texts count as empty."""
    keep = [c for c in df.columns if c not in texts]
    added = StructType.fromDDL(fields)
    types = [(x.name, to_arrow_type(x.dataType)) for x in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, texts):
                made = [f(*(x or "" for x in row)) for row in zip(*(part.column(t).to_pylist() for t in texts), strict=True)]
                new = [pa.array([m[name] for m in made], kind) for name, kind in types]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *new], [*keep, *added.names])

    return df.mapInArrow(run, StructType([*[df.schema[c] for c in keep], *added]))


def per_text(df: DataFrame, text: str, fields: str, f: Callable[[str], dict]) -> DataFrame:
    return per_texts(df, [text], fields, f)


def lex(df: DataFrame, text: str) -> DataFrame:
    """plain and spans of tagged texts."""

    def one(x: str) -> dict:
        plain, spans = S.lex(x)
        return {"plain": plain, "spans": _rows(spans)}

    return per_text(df, text, f"plain string, spans {SPANS}", one)


def parse(df: DataFrame, text: str) -> DataFrame:
    """Numbers of questions, options and repeated numbers, confidence and spans of the exam in plain texts (SEQ-27)."""

    def one(x: str) -> dict:
        e = E.parse_exam(x)
        return {"questions": e.questions, "options": e.options, "repeated": e.repeated, "confidence": e.confidence, "spans": _rows(e.spans)}

    return per_text(df, text, f"questions int, options int, repeated int, confidence double, spans {SPANS}", one)


def parse_lines(df: DataFrame, text: str) -> DataFrame:
    """Question spans of plain texts by fixed expressions, and the number of questions (SEQ-29)."""

    def one(x: str) -> dict:
        spans = S.parse_questions(x)
        return {"questions": sum(s.label == "question_label" for s in spans), "spans": _rows(spans)}

    return per_text(df, text, f"questions int, spans {SPANS}", one)


def coverage(df: DataFrame, raw: str, tagged: str) -> DataFrame:
    """How many questions of raw texts their tagged forms have (JN-15, SCR-8)."""
    return per_texts(df, [raw, tagged], "detected int, annotated int, matched int, missing array<string>, score double, severity string", E.coverage)


def balance(df: DataFrame, text: str) -> DataFrame:
    """Faults of tags by kind, whether rebalancing mends them, and a score from 100 down."""

    def one(x: str) -> dict:
        faults, after = S.check_balance(x), S.check_balance(S.rebalance(x))
        lost = 40 * faults["truncated"] + 10 * faults["unexpected"] + 15 * faults["mismatched"] + 10 * faults["unclosed"]
        return {**faults, "score": max(0, 100 - lost), "mended": not any(after[k] for k in ("unclosed", "unexpected", "mismatched"))}

    return per_text(df, text, "unclosed int, unexpected int, mismatched int, truncated int, score int, mended boolean", one)


def merge(df: DataFrame, doc: str, order: str, raw: str, chunk: str) -> DataFrame:
    """One tagged document of the overlapping raw chunks of each doc and their tagged forms: doc, tagged, level, n_spans.

    The chunks of a document come together in an aggregation; Python then sees batches of documents, not a call for each."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    given = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), empty(raw).alias("r"), empty(chunk).alias("c"))))
    docs = df.groupBy(doc).agg(given.alias("p")).select(doc, F.transform("p", lambda p: p["r"]).alias("raws"), F.transform("p", lambda p: p["c"]).alias("chunks"))
    added = StructType.fromDDL("tagged string, level string, n_spans int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, ["raws", "chunks"]):
                made = [S.merge_raw(raws, chunks) for raws, chunks in zip(part.column("raws").to_pylist(), part.column("chunks").to_pylist(), strict=True)]
                new = [pa.array([m[1] for m in made], pa.string()), pa.array([m[3] for m in made], pa.string()), pa.array([len(m[2]) for m in made], pa.int32())]
                yield pa.RecordBatch.from_arrays([part.column(doc), *new], [doc, *added.names])

    return docs.mapInArrow(run, StructType([docs.schema[doc], *added]))


def chunk_pages(df: DataFrame, doc: str, page: str, words: str, target: int, most: int, overlap: int = 1) -> DataFrame:
    """Greedy page chunks with overlap: doc, chunk, pages, context."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(page)
        numbers = rows[page].tolist()
        chunks = S.page_chunks(rows[words].tolist(), target, most, overlap)
        return pd.DataFrame({doc: [rows[doc].iloc[0]] * len(chunks), "chunk": range(len(chunks)), "pages": [[numbers[i] for i in own] for own, _ in chunks], "context": [[numbers[i] for i in c] for _, c in chunks]})

    kind = dict(df.dtypes)[doc]
    return df.select(doc, page, words).groupBy(doc).applyInPandas(run, f"{doc} {kind}, chunk int, pages array<int>, context array<int>")


def hierarchy(df: DataFrame, doc: str, order: str, event: str, number: str) -> DataFrame:
    """Groups of the events of each doc: doc, kind, number, status."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        found = S.hierarchy(list(zip(rows[event], rows[number].astype(int), strict=True)))
        return pd.DataFrame({doc: [rows[doc].iloc[0]] * len(found), "kind": [x[0] for x in found], "number": [x[1] for x in found], "status": [x[2] for x in found]})

    kind = dict(df.dtypes)[doc]
    return df.select(doc, order, event, number).groupBy(doc).applyInPandas(run, f"{doc} {kind}, kind string, number long, status string")


def similarity(a: str, b: str) -> Column:
    """Ratio of matching characters of two columns (difflib), not an edit distance."""

    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        return pd.Series([SequenceMatcher(None, p or "", q or "", autojunk=False).ratio() for p, q in zip(x, y, strict=True)])

    return F.pandas_udf(ratio, "double")(a, b)


def nfc(text: str | Column) -> Column:
    def many(x: pd.Series) -> pd.Series:
        return x.map(lambda t: None if t is None else S.normalise_map(t)[0])

    return F.pandas_udf(many, "string")(text)


def repair_json(raw: str | Column) -> Column:
    """Repaired JSON, null where it still is none."""

    def one(x: str | None) -> str | None:
        fixed = S.repair_json(x or "")
        try:
            json.loads(fixed)
        except ValueError:
            return None
        return fixed

    def many(x: pd.Series) -> pd.Series:
        return x.map(one)

    return F.pandas_udf(many, "string")(raw)


def json_array(reply: str | Column) -> Column:
    """The array in a model's reply: the whole, else the first list in an object, else the outermost brackets, else an empty one."""
    raw = F.regexp_replace(F.col(reply) if isinstance(reply, str) else reply, r"```[A-Za-z]*\n?", "")
    kind = F.schema_of_variant(F.try_parse_json(raw))
    outer = F.regexp_extract(raw, r"(?s)\[.*\]", 0)
    return F.when(kind.startswith("ARRAY"), F.regexp_replace(raw, r"^\s+|\s+$", "")).when(F.try_parse_json(outer).isNotNull() & (outer != ""), outer).otherwise("[]")


def ladder(record: str) -> dict:
    """Where the texts of a record (text, after) overlap, and how sure that is; nothing at the end of the first where they don't."""
    r = json.loads(record)
    found = S.boundary(r.get("text") or "", r.get("after") or "") or (len(r.get("text") or ""), len(r.get("text") or ""), 0, 0, 0.0)
    return dict(zip(("before_start", "before_end", "after_start", "after_end", "confidence"), found, strict=True))


def smoothed(text: str) -> dict:
    """Labels of word pieces of four characters, each word's pieces as one."""
    labels, more = [], []
    for word in text.split():
        pieces = [word[i : i + 4] for i in range(0, len(word), 4)]
        labels += ["B-number" if p.isdigit() else "B-name" if p[0].isupper() else "O" for p in pieces]
        more += [k > 0 for k in range(len(pieces))]
    return {"labels": S.smooth_subwords(labels, more)}


def protected(text: str) -> dict:
    """Labels of words, those of one figure tag alike."""
    words = text.split()
    return {"labels": G.protect_atomic(words, ["B-name" if w[0].isupper() or w.startswith("<") else "O" for w in words])}
