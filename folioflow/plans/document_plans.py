"""Queries of sequential operators.  SQL cannot express most of them; tests compare them with written cases."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.operators import documents as D
from folioflow.operators import spans as S
from folioflow.operators.curate import farthest_first_quotas
from folioflow.registry import query, read, read_texts


@query()
def lex_annotations(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-16, SEQ-26: tagged turns to text and spans."""
    tagged = F.concat(F.lit("<stem>"), "text", F.lit("</stem><option_label>A.</option_label>"))
    return D.lex(read(spark, d, "conversations").select("conv_id", "turn", tagged.alias("x")), "x")


def _numbered(text: Column) -> Column:
    """A text as an exam of two questions, the first without options, in one section."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.lit("Part I. Questions\nCâu 1. "), F.substr(text, F.lit(1), half), F.lit("\nCâu 2. "), F.substr(text, half + 1), F.lit("\nA. x\nB. y\nC. z\nSolution: B"))


@query()
def det_parse(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-27, TXT-25, ORD-5: sections, questions, options and explanations by the style of numbering that fits best."""
    return D.parse(read_texts(spark, d).select("doc_id", _numbered(F.coalesce("text", F.lit(""))).alias("x")), "x")


@query()
def line_parse(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-29: questions and options by the beginnings of lines."""
    half = F.floor(F.length("text") / 2).cast("int")
    text = F.concat(F.lit("1. "), F.substr("text", F.lit(1), half), F.lit("\nA. one\nB. two\n2) "), F.substr("text", half + 1), F.lit("\nA. x\nB. y\nC. z"))
    return D.parse_lines(read_texts(spark, d).select("doc_id", text.alias("x")), "x")


@query()
def merge_chunks(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-12, SEQ-17 to SEQ-24: overlapping raw chunks and their tagged forms to one tagged document."""
    docs = read_texts(spark, d).select("doc_id", F.coalesce("text", F.lit("")).alias("x"), F.floor(F.length("text") * 0.4).cast("int").alias("a"), F.floor(F.length("text") * 0.6).cast("int").alias("b"))
    head, both, tail = F.substr("x", F.lit(1), F.col("b")), F.substr("x", F.col("a") + 1, F.col("b") - F.col("a")), F.substr("x", F.col("b") + 1)
    first = docs.select("doc_id", F.lit(0).alias("i"), head.alias("raw"), F.concat(F.lit("<stem>"), head, F.lit("</stem>")).alias("chunk"))
    second = docs.select("doc_id", F.lit(1).alias("i"), F.concat(both, tail).alias("raw"), F.concat(both, F.lit("<option_text>"), tail, F.lit("</option_text>")).alias("chunk"))
    return D.merge(first.unionAll(second), "doc_id", "i", "raw", "chunk")


@query()
def xml_checker(spark: SparkSession, d: str) -> DataFrame:
    """SCR-2, SCR-19, SEQ-34, SEQ-35: faults of tags by a stack, and whether rebalancing mends them."""
    return D.balance(read(spark, d, "pages").select("page_id", "html"), "html")


@query(r"""with recursive t as (select conv_id, row_number() over (partition by conv_id order by turn) k, lead(turn) over (partition by conv_id order by turn) is null as final, cast(turn as integer) turn, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) w from conversations),
r as (select conv_id, k, final, 0 as chunk, [turn] own, cast([] as integer[]) context, turn, w, w as total from t where k = 1
union all select t.conv_id, t.k, t.final, r.chunk + cast(r.total >= 60 as integer), case when r.total >= 60 then [t.turn] else list_append(r.own, t.turn) end, case when r.total >= 60 then [r.turn] else r.context end, t.turn, t.w, case when r.total >= 60 then r.w else r.total end + t.w from r join t on t.conv_id = r.conv_id and t.k = r.k + 1)
select conv_id, cast(chunk as integer) as chunk, own as pages, context from r where total >= 60 or final""")
def page_chunker_overlap(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-1, SEQ-2: chunks of pages with one page of overlap."""
    turns = read(spark, d, "conversations").select("conv_id", F.col("turn").cast("int").alias("turn"), F.size(X.split_words("text")).alias("w"))
    return D.chunk_pages(turns, "conv_id", "turn", "w", 60, 100)


@query(r"""with e as (select conv_id, turn, role, cast(turn // 2 as bigint) as n, min(case when role in ('system', 'user') then turn end) over (partition by conv_id order by turn rows between 1 following and unbounded following) stop from conversations)
select conv_id, 'SECTION' as kind, n as number, 'PARTIAL_CLOSED' as status from e where role = 'system'
union all select conv_id, 'Q', n, case when exists (select 1 from e x where x.conv_id = e.conv_id and x.role not in ('system', 'user') and x.n = e.n and x.turn > e.turn and (e.stop is null or x.turn < e.stop)) then 'CLOSED' else 'PARTIAL_CLOSED' end from e where role = 'user'""")
def hierarchy_stack(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-31: nested groups of begin and end events."""
    role = F.col("role")
    name = F.when(role == "system", "SECTION_START").when(role == "user", "Q_START").otherwise("Q_END")
    number = F.floor(F.col("turn") / 2)
    return D.hierarchy(read(spark, d, "conversations").select("conv_id", "turn", name.alias("event"), number.alias("number")), "conv_id", "turn", "event", "number")


@query(r"""with recursive v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) x from embeddings where len(embedding) % 4 = 0),
r as (select vec_id, x, 1 as t, [x[1], x[2], x[3] - 10000, x[4]] s, [[0], [1], [2], [3]] p from v
union all select vec_id, x, t + 1, list_transform(b, lambda m, j: list_max(m) + x[4 * t + j]), list_transform(b, lambda m, j: list_append(p[list_position(m, list_max(m))], j - 1))
from (select *, [s, s, [s[1] - 10000, s[2], s[3], s[4] - 10000], s] b from r where t < len(x) // 4))
select vec_id, list_transform(p[list_position(s, list_max(s))], lambda k: cast(k as integer)) as path from r where t = len(x) // 4""")
def viterbi_decode(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-37, WIN-9: best BIO paths of emissions (an embedding as 16 steps of 4 tags), Arrow batches of vectors."""
    tags = ["O", "B-q", "I-q", "B-a"]

    @F.pandas_udf("array<int>")
    def decode(x: pd.Series) -> pd.Series:
        return pd.Series([S.viterbi(np.asarray(v, dtype=float).reshape(-1, 4), tags) for v in x])

    return read(spark, d, "embeddings").where(F.size("embedding") % 4 == 0).select("vec_id", decode("embedding").alias("path"))


@query()
def latex_spans(spark: SparkSession, d: str) -> DataFrame:
    """TXT-17, TXT-18, TXT-20: formulas with offsets, and whether they are well formed."""

    def one(x: str) -> dict:
        found = S.latex_spans(x)
        return {"n": len(found), "places": [list(p) for p in found], "valid": sum(S.latex_valid(x[a:b].strip("$")) for a, b in found)}

    return D.per_text(read_texts(spark, d).select("doc_id", "text"), "text", "n int, places array<array<int>>, valid int", one)


@query(r"""select doc_id, cast(length(x) as integer) as chars, cast(nullif(length(regexp_replace(text, '(\s+|[^\s]\p{M}*)$', '')), length(text)) as integer) as last, md5(x) as digest from (select doc_id, coalesce(text, '') as text, nfc_normalize(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) x from documents)""")
def whitespace_nfc_map(spark: SparkSession, d: str) -> DataFrame:
    """TXT-5, TXT-6, TXT-43: normalised text with the place of each kept character."""

    def one(x: str) -> dict:
        plain, where = S.normalise_map(x)
        return {"chars": len(plain), "last": where[-1] if where else None, "digest": hashlib.md5(plain.encode()).hexdigest()}

    return D.per_text(read_texts(spark, d).select("doc_id", "text"), "text", "chars int, last int, digest string", one)


@query()
def fuzzy_question_match(spark: SparkSession, d: str) -> DataFrame:
    """JN-15, SCR-8: questions of raw documents in their tagged forms, of which some have other labels or are left out."""
    x, k = F.coalesce("text", F.lit("")), F.col("doc_id") % 4
    half = F.floor(F.length(x) / 2).cast("int")
    one = lambda label, stem: F.concat(F.lit(f"<question_label>{label}</question_label><stem>"), stem, F.lit("</stem>"))
    first = F.when(k == 0, one("Câu 01.", F.substr(x, F.lit(1), half))).when(k == 1, one("7)", F.substr(x, F.lit(1), half))).when(k == 2, one("Câu 1.", F.lit("something else")))
    tagged = F.concat(F.coalesce(first, F.lit("")), F.when(k == 3, F.lit("")).otherwise(one("Câu 2.", F.substr(x, half + 1))))
    return D.coverage(read_texts(spark, d).select("doc_id", _numbered(x).alias("raw"), tagged.alias("tagged")), "raw", "tagged")


@query()
def question_similarity(spark: SparkSession, d: str) -> DataFrame:
    """SCR-9: texts that have the same number on both sides, and how similar they are."""
    w = Window.partitionBy("conv_id", "role").orderBy("turn")
    rows = read(spark, d, "conversations").withColumn("n", F.row_number().over(w))
    a, b = (rows.where(F.col("role") == r).select("conv_id", "n", F.col("turn").alias(t), F.col("text").alias(x)) for r, t, x in (("user", "turn", "x"), ("assistant", "other", "y")))
    return a.join(b, ["conv_id", "n"]).select("conv_id", "turn", "other", F.round(D.similarity("x", "y"), 6).alias("ratio"))


@query(r"""with g as (select doc_id, unnest(range(0, greatest(length(text) - 5, 0), 10)) a from documents), m as (select doc_id, a, (select count(*) from (select unnest([a - 10, a, a + 10]) o) where abs(o - (a + a % 3)) <= 1 and o + 5 = a + 5) hit from g)
select d.doc_id, cast(coalesce(sum(hit), 0) as integer) as tp, cast(coalesce(sum(1 - hit), 0) as integer) as fp, cast(coalesce(sum(1 - hit), 0) as integer) as fn from documents d left join m using (doc_id) group by 1""")
def greedy_span_match(spark: SparkSession, d: str) -> DataFrame:
    """JN-19: predicted spans take gold ones within a tolerance, each once."""

    def one(x: str) -> dict:
        gold = [S.Span(a, a + 5, "w") for a in range(0, len(x) - 5, 10)]
        tp, fp, fn = S.match_spans(gold, [S.Span(s.start + s.start % 3, s.end, "w") for s in gold], 1).get("w", (0, 0, 0))
        return {"tp": tp, "fp": fp, "fn": fn}

    return D.per_text(read_texts(spark, d).select("doc_id", "text"), "text", "tp int, fp int, fn int", one)


@query()
def overlap_resolution(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-19 to SEQ-22, SEQ-25: overlapping candidates resolved, nested and written as tags; the text stays."""

    def one(x: str) -> dict:
        spans = [S.Span(a, min(a + 12, len(x)), "stem", 1 - a % 7 / 10) for a in range(0, max(len(x) - 12, 0), 8)]
        chosen, rejected = S.resolve_overlaps(spans)
        tagged = S.serialize(x, chosen)
        return {"chosen": len(chosen), "rejected": len(rejected), "faithful": S.lex(tagged, ("stem",))[0] == x}

    return D.per_text(read_texts(spark, d).select("doc_id", "text"), "text", "chosen int, rejected int, faithful boolean", one)


@query()
def search_replace_patch(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-36: search and replace blocks of a reply applied to a text."""

    def one(x: str) -> dict:
        words = x.split()
        old = " ".join(words[3:8])
        patched, refused = S.apply_patches(x, f"<<<<<<< SEARCH\n{old}\n=======\nNEW\n>>>>>>> REPLACE")
        return {"applied": "NEW" in patched, "refused": len(refused), "chars": len(patched)}

    return D.per_text(read_texts(spark, d).select("doc_id", "text"), "text", "applied boolean, refused int, chars int", one)


@query(r"""select doc_id, p is null as same, cast(p - 1 as integer) as place from (select doc_id, list_position(list_transform(list_zip(string_split(regexp_replace(x, '\s', '', 'g'), ''), string_split(regexp_replace(y, '\s', '', 'g'), '')), lambda z: z[1] is distinct from z[2]), true) p
from (select doc_id, x, substr(x, 1, 50) || chr(10) || substr(x, 51, 40) || case when length(x) % 2 = 1 then '' else '#' end || substr(x, 91) y from (select doc_id, coalesce(text, '') x from documents)))""")
def fidelity_first_difference(spark: SparkSession, d: str) -> DataFrame:
    """FLT-12: where two texts first differ but for white space."""

    def one(x: str) -> dict:
        found = S.first_difference(x, x[:50] + "\n" + x[50:90] + ("" if len(x) % 2 else "#") + x[90:])
        return {"same": found is None, "place": found[0] if found else None}

    return D.per_text(read_texts(spark, d).select("doc_id", "text"), "text", "same boolean, place int", one)


@query(r"""with recursive w as (select doc_id, u.i, sum(1 + length(u.w) // 4) over (partition by doc_id order by u.i) c from (select doc_id, unnest(list_zip(x, range(1, len(x) + 1))) z from (select doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') x from documents)) q, lateral (select q.z[1] w, q.z[2] i) u),
l as (select doc_id, list(cast(c as bigint) order by i) c from w group by 1),
r as (select doc_id, c, 1 as n, greatest(1, len(list_filter(c, lambda v: v <= 128))) as e, 0 as start from l
union all select doc_id, c, n + 1, greatest(b + 1, len(list_filter(c, lambda v: v <= coalesce(c[b], 0) + 128))), b from (select *, greatest(start + 1, 1 + len(list_filter(c, lambda v: v < c[e] - 16))) b from r where e < len(c)))
select d.doc_id, cast(coalesce(max(n), 0) as integer) as n, cast(coalesce(max(e), 0) as integer) as last_end from documents d left join r using (doc_id) group by 1""")
def word_budget_windows(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-9: windows of whole words within a budget of pieces."""

    def one(x: str) -> dict:
        found = S.word_windows([1 + len(w) // 4 for w in x.split()], 128, 16)
        return {"n": len(found), "last_end": found[-1][1] if found else 0}

    return D.per_text(read_texts(spark, d).select("doc_id", "text"), "text", "n int, last_end int", one)


@query(r"""with recursive b as (select user_id, event_id, row_number() over (partition by user_id order by event_id) k, cast(trunc(value % 90 + 10) as integer) w, cast(trunc(value % 40 + 5) as integer) h from events),
r as (select user_id, event_id, k, 0 as canvas, 0 as x, 0 as y, w, h as shelf from b where k = 1
union all select user_id, event_id, k, case when full_page then canvas + 1 else canvas end, case when wraps or full_page then 0 else x end, case when full_page then 0 else y end, w, case when wraps or full_page then h else greatest(shelf, h) end
from (select *, y > 0 and y + h > 100 as full_page from (select b.user_id, b.event_id, b.k, r.canvas, r.x + r.w + b.w > 200 as wraps, r.x + r.w as x, case when r.x + r.w + b.w > 200 then r.y + r.shelf else r.y end as y, b.w, b.h, r.shelf from r join b on b.user_id = r.user_id and b.k = r.k + 1)))
select user_id, event_id, canvas, x, y from r""")
def shelf_packing(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-5: boxes in rows of canvases, by user."""
    boxes = read(spark, d, "events").select("user_id", "event_id", (F.col("value") % 90 + 10).cast("int").alias("w"), (F.col("value") % 40 + 5).cast("int").alias("h"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("event_id")
        placed = S.shelf_pack(list(zip(rows.w, rows.h, strict=True)), 200, 100)
        return rows[["user_id", "event_id"]].assign(canvas=[p[0] for p in placed], x=[p[1] for p in placed], y=[p[2] for p in placed])

    return boxes.groupBy("user_id").applyInPandas(run, "user_id long, event_id long, canvas int, x int, y int")


@query()
def farthest_first(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-40: vectors far from each other until the documents of each tier have its tokens."""
    rows = read(spark, d, "embeddings").select("vec_id", (F.col("vec_id") % 3).cast("string").alias("tier"), (F.col("vec_id") * 37 % 900 + 100).alias("tokens"), F.col("embedding").alias("v"))
    return farthest_first_quotas(rows, "vec_id", "tier", "tokens", "v", {"0": 6000, "1": 4000, "2": 2000}, 800)


@query(r"""select doc_id, case when text is not null then cast(doc_id as varchar) end as n from documents""")
def json_repair(spark: SparkSession, d: str) -> DataFrame:
    """SRC-13: model JSON with stray backslashes and line breaks."""
    raw = F.concat(F.lit('{"stem": "\\alpha '), F.translate("text", '"', "'"), F.lit('\n", "n": '), "doc_id", F.lit("}"))
    return read_texts(spark, d).select("doc_id", F.get_json_object(D.repair_json(raw), "$.n").alias("n"))


@query("""select event_id, case event_id % 3 when 0 then '[1, 2]' when 1 then '[' || event_id || ']' else '[]' end as items from events""")
def json_array_recovery(spark: SparkSession, d: str) -> DataFrame:
    """SRC-14: the array in a model's reply, however it is wrapped."""
    e = F.col("event_id")
    reply = F.when(e % 3 == 0, F.lit("```json\n[1, 2]\n```")).when(e % 3 == 1, F.concat(F.lit('{"items": ['), e.cast("string"), F.lit("]}"))).otherwise(F.lit("no array"))
    return read(spark, d, "events").select("event_id", D.json_array(reply).alias("items"))
