"""Queries of discovery, structure checks, manifests and synthetic generation."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.operators import documents as D
from folioflow.operators import spans as S
from folioflow.operators import synthetic as G
from folioflow.registry import query, read, read_texts


@query("""select conv_id, turn, 'chunk' as kind from conversations where role = 'assistant' union all select conv_id, min(turn), 'merged' from conversations where conv_id not in (select conv_id from conversations where role = 'assistant') group by conv_id""")
def exam_tree_scan(spark: SparkSession, d: str) -> DataFrame:
    """SRC-5: chunks where a document has any, else its merged text; never both."""
    rows = read(spark, d, "conversations")
    chunks = rows.where("role = 'assistant'")
    merged = rows.join(chunks.select("conv_id").distinct(), "conv_id", "left_anti").groupBy("conv_id").agg(F.min("turn").alias("turn"))
    return chunks.select("conv_id", "turn", F.lit("chunk").alias("kind")).unionAll(merged.select("conv_id", "turn", F.lit("merged").alias("kind")))


@query("""with t as (select source, count(*) n from documents group by source having count(*) > 1), i as (select distinct 'src' || (page_id % 12) name from pages) select t.source, n, coalesce(e.name, (select min(name) from i where starts_with(t.source, i.name))) as input from t left join i e on e.name = t.source""")
def target_discovery(spark: SparkSession, d: str) -> DataFrame:
    """SRC-7: documents of several chunks and their input: by name, else by the name's beginning."""
    t = read(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    names = read(spark, d, "pages").select(F.concat(F.lit("src"), F.col("page_id") % 12).alias("name")).distinct()
    exact = t.join(names, F.col("source") == F.col("name"), "left")
    # all beginnings of a name meet the inputs' names, instead of every name with every input
    heads = t.select("source", F.explode(F.transform(F.sequence(F.lit(1), F.length("source")), lambda k: F.substring("source", F.lit(1), k))).alias("name"))
    fuzzy = heads.join(names, "name").groupBy("source").agg(F.min("name").alias("fuzzy"))
    return exact.join(fuzzy, "source", "left").select("source", "n", F.coalesce("name", "fuzzy").alias("input"))


@query("select doc_id, source from (select doc_id, source, case when n_chars < 500 then 'DISCARD' when n_chars < 1000 then 'NEEDS_REVISION' else 'PASS' end as decision from documents) where decision = 'DISCARD' and doc_id in (select doc_id from labels)")
def defective_chunks(spark: SparkSession, d: str) -> DataFrame:
    """SRC-20: discarded chunks whose record exists."""
    decision = F.when(F.col("n_chars") < 500, "DISCARD").when(F.col("n_chars") < 1000, "NEEDS_REVISION").otherwise("PASS")
    return read_texts(spark, d).where(decision == "DISCARD").join(read(spark, d, "labels").select("doc_id"), "doc_id", "left_semi").select("doc_id", "source")


@query(r"""select doc_id, case when t <> '' and (starts_with('<stem', t) or starts_with('<section', t) or starts_with('</stem', t)) then substring(x, 1, length(x) - length(t)) else x end as trimmed from (select doc_id, x, regexp_extract(x, '</?[A-Za-z_]*\z') t from (select doc_id, text || case doc_id % 4 when 0 then '<ste' when 1 then '</st' when 2 then '<i' else '' end x from documents))""")
def trim_unclosed_tag(spark: SparkSession, d: str) -> DataFrame:
    """TXT-9: a trailing tag that was cut off goes if it begins like one of the schema."""
    k = F.col("doc_id") % 4
    rows = read_texts(spark, d).select("doc_id", F.concat("text", F.when(k == 0, "<ste").when(k == 1, "</st").when(k == 2, "<i").otherwise("")).alias("x"))
    t = F.regexp_extract("x", r"</?[A-Za-z_]*\z", 0)
    known = F.lit(False)
    for tag in ("<stem", "<section", "</stem"):
        known = known | F.startswith(F.lit(tag), t)
    return rows.select("doc_id", F.when((t != "") & known, F.expr("substring(x, 1, length(x) - length(regexp_extract(x, '</?[A-Za-z_]*\\\\z', 0)))")).otherwise(F.col("x")).alias("trimmed"))


@query("""with l as (select conv_id, turn, case when turn > 5 then '**' || turn || '.** invented' else text end x from conversations), b as (select conv_id, min(turn) cut from l where regexp_matches(x, '^\\*\\*\\d+\\.\\*\\*') group by 1) select l.conv_id, turn from l left join b using (conv_id) where cut is null or turn < cut""")
def prune_tail(spark: SparkSession, d: str) -> DataFrame:
    """TXT-10: everything from the first numbered line that the source lacks goes."""
    x = F.when(F.col("turn") > 5, F.concat(F.lit("**"), "turn", F.lit(".** invented"))).otherwise(F.col("text"))
    lines = read(spark, d, "conversations").select("conv_id", "turn", x.alias("x"))
    cut = F.min(F.when(F.col("x").rlike(r"^\*\*\d+\.\*\*"), F.col("turn"))).over(Window.partitionBy("conv_id"))
    return lines.withColumn("cut", cut).where("cut is null or turn < cut").select("conv_id", "turn")


@query(r"""select page_id, case when regexp_matches(x, 'math|number') then 'maths' when regexp_matches(x, 'news|press') then 'press' else 'other' end as subject, try_cast(nullif(regexp_extract(x, '(19\d\d|20\d\d)', 1), '') as integer) as year, try_cast(nullif(regexp_extract(x, 'page[-_ ]?(\d+)', 1), '') as integer) as number from (select page_id, lower(url) || ' ' || lower(substring(html, 1, 300)) x from pages)""")
def heuristic_metadata(spark: SparkSession, d: str) -> DataFrame:
    """TXT-14: ordered patterns over name and first text."""
    x = F.concat_ws(" ", F.lower("url"), F.lower(F.substring("html", 1, 300)))
    number = lambda p: F.nullif(F.regexp_extract(x, p, 1), F.lit("")).try_cast("int")
    return read(spark, d, "pages").select("page_id", F.when(x.rlike("math|number"), "maths").when(x.rlike("news|press"), "press").otherwise("other").alias("subject"), number(r"(19\d\d|20\d\d)").alias("year"), number(r"page[-_ ]?(\d+)").alias("number"))


@query(r"""select doc_id, cast(len(regexp_extract_all(text, '\$[^$\n]+\$|[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) as bigint) as atomic, cast(len(regexp_extract_all(regexp_replace(text, '</?[A-Za-z][^>]*>', '', 'g'), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) as bigint) as plain from documents""")
def tokenizer_variants(spark: SparkSession, d: str) -> DataFrame:
    """TXT-22, TXT-23: tokens with whole formulas, and tokens without tags."""
    atomic = F.regexp_extract_all("text", F.lit(r"\$[^$\n]+\$|" + X.TOKEN), F.lit(0))
    return read_texts(spark, d).select("doc_id", F.size(atomic).cast("long").alias("atomic"), F.size(X.tokens(F.regexp_replace("text", r"</?[A-Za-z][^>]*>", ""))).cast("long").alias("plain"))


@query("""select conv_id, string_agg('<page_metadata>{"p": ' || (10 + rn) || '}</page_metadata>', '' order by turn) as blocks from (select conv_id, turn, row_number() over (partition by conv_id order by turn) - 1 rn from conversations) group by conv_id""")
def metadata_renumber(spark: SparkSession, d: str) -> DataFrame:
    """TXT-38: the i-th metadata block gets the number start + i."""
    turns = F.array_sort(F.collect_list("turn"))
    block = lambda t, i: F.concat(F.lit('<page_metadata>{"p": '), (i + 10).cast("string"), F.lit("}</page_metadata>"))
    return read(spark, d, "conversations").groupBy("conv_id").agg(turns.alias("t")).select("conv_id", F.array_join(F.transform("t", block), "").alias("blocks"))


@query("""select doc_id, len(list_filter([[0, 5], [7, 7], [10, 30]], lambda s: s[2] > s[1] and trim(substring(text, s[1] + 1, s[2] - s[1])) <> '')) as kept from documents""")
def zero_length_spans(spark: SparkSession, d: str) -> DataFrame:
    """FLT-4: spans of some text."""
    spans = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((0, 5), (7, 7), (10, 30))])
    return read_texts(spark, d).select("doc_id", F.size(F.filter(spans, lambda s: (s["b"] > s["a"]) & (F.trim(F.substr("text", s["a"] + 1, s["b"] - s["a"])) != ""))).cast("long").alias("kept"))


@query(r"""select conv_id, not bool_or(regexp_matches(x, '<stem>\s*</stem>')) as valid, cast(sum(len(regexp_extract_all(x, '</question_label>\s*<option_label>'))) as bigint) as adjacent from (select conv_id, case turn % 3 when 0 then '<stem> </stem>' when 1 then '<question_label>1</question_label><option_label>A</option_label>' else '<stem>x</stem>' end x from conversations) group by conv_id""")
def cloze_validity(spark: SparkSession, d: str) -> DataFrame:
    """FLT-10: no empty stems; how often options follow a label at once."""
    k = F.col("turn") % 3
    x = F.when(k == 0, "<stem> </stem>").when(k == 1, "<question_label>1</question_label><option_label>A</option_label>").otherwise("<stem>x</stem>")
    rows = read(spark, d, "conversations").select("conv_id", x.alias("x"))
    return rows.groupBy("conv_id").agg((~F.bool_or(F.col("x").rlike(r"<stem>\s*</stem>"))).alias("valid"), F.sum(F.regexp_count("x", F.lit(r"</question_label>\s*<option_label>"))).cast("long").alias("adjacent"))


@query("select doc_id, row_number() over (partition by source order by case when lang = 'en' then 1 else 0 end, doc_id) as place from documents")
def priority_order(spark: SparkSession, d: str) -> DataFrame:
    """FLT-15: other subjects first, otherwise in the given order."""
    return read_texts(spark, d).select("doc_id", F.row_number().over(Window.partitionBy("source").orderBy(F.when(F.col("lang") == "en", 1).otherwise(0), "doc_id")).cast("long").alias("place"))


@query(r"""select doc_id, case when regexp_matches(x, '(?m)^(?:<{5,9}|={5,9}|>{5,9})') then 0 else 100 end as conflict_score, len(list_filter(regexp_extract_all(x, '(?s)<stimulus>(.*?)</stimulus>', 1), lambda s: regexp_matches(s, '</?(?:stem|option_text|question_label)'))) as nested
from (select doc_id, case doc_id % 3 when 0 then '<stimulus>a<stem>b</stem></stimulus>' when 1 then '<stimulus>' || text || '</stimulus>' else '=======' || chr(10) || 'x' end x from documents)""")
def conflict_and_nesting(spark: SparkSession, d: str) -> DataFrame:
    """SCR-3, SCR-5: conflict markers, and tags within stimuli."""
    k = F.col("doc_id") % 3
    x = F.when(k == 0, "<stimulus>a<stem>b</stem></stimulus>").when(k == 1, F.concat(F.lit("<stimulus>"), "text", F.lit("</stimulus>"))).otherwise("=======\nx")
    inner = F.regexp_extract_all("x", F.lit("(?s)<stimulus>(.*?)</stimulus>"), F.lit(1))
    rows = read_texts(spark, d).select("doc_id", x.alias("x"))
    return rows.select("doc_id", F.when(X.has_conflict_markers("x"), 0).otherwise(100).alias("conflict_score"), F.size(F.filter(inner, lambda s: s.rlike("</?(?:stem|option_text|question_label)"))).cast("long").alias("nested"))


@query("""with c as (select conv_id, count(*) filter (where role = 'user') q, count(*) filter (where role = 'assistant') o from conversations group by conv_id) select conv_id, q as questions, o as options, case when q = 0 then 0.0 else round((q - o) / cast(q as double), 6) end as missing_rate, case when q - o >= 4 or (q > 0 and (q - o) / cast(q as double) > 0.15) then 'MAJOR' when q <> o then 'MINOR' else 'NONE' end as severity from c""")
def question_structure(spark: SparkSession, d: str) -> DataFrame:
    """SCR-7: questions without options: major from four on or above 15 %."""
    q, o = F.count_if(F.col("role") == "user"), F.count_if(F.col("role") == "assistant")
    c = read(spark, d, "conversations").groupBy("conv_id").agg(q.alias("questions"), o.alias("options"))
    gap = F.col("questions") - F.col("options")
    rate = F.when(F.col("questions") == 0, 0.0).otherwise(gap / F.greatest("questions", F.lit(1)))
    return c.select("conv_id", "questions", "options", F.round(rate, 6).alias("missing_rate"), F.when((gap >= 4) | (rate > 0.15), "MAJOR").when(gap != 0, "MINOR").otherwise("NONE").alias("severity"))


@query(r"""select page_id, i as place, kind from (select page_id, unnest(ts) t, generate_subscripts(ts, 1) i from (select page_id, regexp_extract_all(lower(html), '<(h[1-6]|p)[ >]', 1) ts from pages)) x, lateral (select case when starts_with(t, 'h') then 'section' else 'question' end kind)""")
def cartography_scan(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-32: sections and questions of pages by pattern."""
    rows = read(spark, d, "pages").select("page_id", F.posexplode(F.regexp_extract_all(F.lower("html"), F.lit("<(h[1-6]|p)[ >]"), F.lit(1))).alias("i", "t"))
    return rows.select("page_id", (F.col("i") + 1).cast("long").alias("place"), F.when(F.col("t").startswith("h"), "section").otherwise("question").alias("kind"))


@query("""with s as (select user_id, event_id, greatest(1, least(20, dayofmonth(ts))) a, greatest(1, least(20, dayofmonth(ts) + event_id % 4)) b, event_type from events) select user_id, count(*) as objects, min(a) as first_page, max(b) as last_page, list_sort(list(event_id) filter (event_type = 'click' and b - a <= 2)) as stimuli from s group by user_id""")
def manifest_build(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-33: objects with their page spans kept within the document."""
    day = F.dayofmonth("ts")
    keep = lambda c: F.greatest(F.lit(1), F.least(F.lit(20), c)).cast("long")
    rows = read(spark, d, "events").select("user_id", "event_id", "event_type", keep(day).alias("a"), keep(day + F.col("event_id") % 4).alias("b"))
    found = F.array_sort(F.collect_list(F.when((F.col("event_type") == "click") & (F.col("b") - F.col("a") <= 2), F.col("event_id"))))
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("objects"), F.min("a").alias("first_page"), F.max("b").alias("last_page"), F.when(F.size(found) > 0, found).alias("stimuli"))


@query()
def augment_jitter(spark: SparkSession, d: str) -> DataFrame:
    """GEN-2, GEN-4, GEN-5: jitter and noise with moved spans; span texts are the same but for what was changed."""

    def one(x: str) -> dict:
        spans = [S.Span(m.start(), m.end(), "word") for m in re.finditer(r"\S+", x)]
        y, moved = G.jitter(x, spans, G.stable_seed(x))
        z, _ = G.noise(x, spans, G.stable_seed(x))
        return {"grown": len(y) - len(x), "faithful": [y[s.start : s.end] for s in moved] == [x[s.start : s.end] for s in spans], "noisy": sum(a != b for a, b in zip(x, z))}

    return D.per_text(read_texts(spark, d).select("doc_id", "text"), "text", "grown int, faithful boolean, noisy int", one)


@query()
def synthetic_questions(spark: SparkSession, d: str) -> DataFrame:
    """GEN-6 to GEN-11, GEN-17, GEN-18, GEN-20, SEQ-28: exams of questions with spans, read back as questions."""

    def one(x: str) -> dict:
        words, seed = x.split() + ["a", "b", "c", "d"], G.stable_seed(x)
        pieces = [G.question(i // 40 + 1, " ".join(words[i : i + 36]), [f"{w}{k}" for k, w in enumerate(words[-4:])], 0, seed + i) for i in range(0, len(words), 40)]
        text, spans = G.exam([(t, s) for t, s, _ in pieces])
        back = G.group_questions(spans, text)
        orders, right = G.ordering_choices(["a", "b", "c", "d"], seed)
        key = "".join(chr(65 + a) for _, _, a in pieces)
        return {"questions": len(back), "options": sum(len(q["options"]) for q in back), "key": key, "right": right, "grid": G.answer_grid(key), "tasks": len(G.blueprint("maths", 5, seed)), "font": G.style(seed)["font"], "head": G.header("school", "maths", 45, str(seed % 1000)).split("\n")[1], "orders": len(orders)}

    return D.per_text(read_texts(spark, d).select("doc_id", "text"), "text", "questions int, options int, key string, right int, grid string, tasks int, font string, head string, orders int", one)


@query()
def dynamic_windows(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-8, SEQ-14: windows of drawn sizes, and what a chunk repeats of the text before it."""

    def one(x: str) -> dict:
        found = G.random_windows(len(x.split()), (64, 128, 256), 0.75, G.stable_seed(x))
        return {"n": len(found), "end": found[-1][1] if found else 0, "repeated": G.repeated_prefix(x[: len(x) * 6 // 10], x[len(x) * 4 // 10 :])}

    return D.per_text(read_texts(spark, d).select("doc_id", "text"), "text", "n int, end int, repeated int", one)


@query()
def reference_expansion(spark: SparkSession, d: str) -> DataFrame:
    """TXT-27, TXT-36, TXT-37, TXT-39: references to chunks, figures and headings."""

    def one(x: str) -> dict:
        text, n = G.expand_references(f"[CHUNK_1] {x} {{{{C_2}}}} [CHUNK_9]", {"1": "one", "2": "two"})
        figures = G.project_figures('<figure id="a"/><figure id="a"/><figure id="z"/>', ["a", "b"])
        return {"expanded": n, "unknown": "[CHUNK_9]" in text, "figures": figures.count("<figure"), "start": G.absorb_heading("## 1. x", S.Span(3, 5, "question_label")).start}

    return D.per_text(read_texts(spark, d).select("doc_id", "text"), "text", "expanded int, unknown boolean, figures int, start int", one)


@query()
def figure_decode(spark: SparkSession, d: str) -> DataFrame:
    """SRC-17, SEQ-39: boxes of raw detections (an embedding as rows of four corners and four logits)."""
    def decode(x: pd.Series) -> pd.Series:
        made = [G.decode_figures([list(map(float, v[i : i + 8])) for i in range(0, len(v) - 7, 8)], 0.5, 1.0, 1.0) for v in x]
        return pd.Series([len(m) for m in made])

    return read(spark, d, "embeddings").where("embedding is not null").select("vec_id", F.pandas_udf(decode, "int")("embedding").alias("boxes"))


@query()
def revision_loop(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-42: rounds of editing and review with functions in place of models."""

    def one(x: str) -> dict:
        def review(t: str) -> tuple[str, float]:
            faults = S.check_balance(t)
            score = 100.0 - 10 * sum(faults.values())
            return ("PASS" if score >= 80 and not faults["unclosed"] else "NEEDS_REVISION"), score

        text, decision, score = G.revise(x, review, S.rebalance)
        return {"decision": decision, "score": score, "changed": text != x}

    return D.per_text(read_texts(spark, d, "pages").select("page_id", "html"), "html", "decision string, score double, changed boolean", one)
