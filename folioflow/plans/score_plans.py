"""Queries of evaluation and audit operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.operators import audit as A
from folioflow.operators import evaluate as E
from folioflow.registry import query, read, read_texts


@query("""select event_type, count(value) n, round(sum(value), 4) total, round(avg(value), 6) mean, round(quantile_cont(value, 0.5), 6) median, round(quantile_cont(value, 0.95), 6) p95, round(quantile_cont(value, 0.99), 6) p99,
min(value) least, max(value) most, round(stddev_pop(value), 6) deviation from events group by 1""")
def doc_stats_describe(spark: SparkSession, d: str) -> DataFrame:
    """AGG-9, AGG-10: descriptive statistics with exact percentiles."""
    return E.describe(read(spark, d, "events"), "value", "event_type")


@query("select round(sum(-p * log2(p)), 6) as entropy from (select count(*) / sum(count(*)) over () as p from documents group by lang)")
def label_entropy(spark: SparkSession, d: str) -> DataFrame:
    """AGG-21: entropy of languages."""
    return E.entropy(read(spark, d, "documents"), "lang")


@query("""with t as (select quality a, toxic b from labels), x as (select count(*) n, sum(case when a = b then 1 else 0 end) same from t),
c as (select sum(na * nb) chance from (select a l, count(*) na from t group by 1) join (select b l, count(*) nb from t group by 1) using (l))
select round(same / n, 6) po, round(chance / (n * n), 6) pe, round(case when chance / (n * n) >= 1 then 1.0 else (same / n - chance / (n * n)) / (1 - chance / (n * n)) end, 6) kappa from x, c""")
def cohen_kappa(spark: SparkSession, d: str) -> DataFrame:
    """AGG-20: agreement of two labels beyond chance."""
    return E.kappa(read(spark, d, "labels"), "quality", "toxic")


@query("""with p as (select lang, quality = 1 g, n_chars >= 500 p from documents join labels using (doc_id)), c as (select lang, count(*) filter (where g and p) tp, count(*) filter (where not g and p) fp, count(*) filter (where g and not p) fn from p group by lang)
select lang, tp, fp, fn, round(case when tp + fp = 0 then 0 else tp / (tp + fp) end, 6) as precision, round(case when tp + fn = 0 then 0 else tp / (tp + fn) end, 6) as recall, round(case when tp = 0 then 0 else 2 * tp / (2 * tp + fp + fn) end, 6) as f1 from c""")
def heuristic_prf(spark: SparkSession, d: str) -> DataFrame:
    """AGG-5: precision, recall and F1 of a length rule, by language."""
    rows = read(spark, d, "documents").select("doc_id", "lang", "n_chars").join(read(spark, d, "labels"), "doc_id")
    return E.prf(E.confusion(rows, F.col("quality") == 1, F.col("n_chars") >= 500, "lang"))


@query("""with p as (select lang, quality = 1 g, n_chars >= 500 p from documents join labels using (doc_id)), c as (select lang, count(*) filter (where g and p) tp, count(*) filter (where not g and p) fp, count(*) filter (where g and not p) fn from p group by lang)
select round(avg(case when tp = 0 then 0 else round(2 * tp / (2 * tp + fp + fn), 6) end), 5) as macro_f1, round(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 6) as micro_f1 from c""")
def macro_average(spark: SparkSession, d: str) -> DataFrame:
    """AGG-6, AGG-7: macro and micro F1 over languages."""
    return heuristic_prf(spark, d).agg(F.round(F.avg("f1"), 5).alias("macro_f1"), F.round(2 * F.sum("tp") / (2 * F.sum("tp") + F.sum("fp") + F.sum("fn")), 6).alias("micro_f1"))


@query("""with c as (select event_type, count(*) n from events group by 1), w as (select *, pow(sum(n) over () / greatest(n, 1), 0.25) w from c) select event_type, n, round(w / avg(w) over (), 6) as weight from w""")
def smoothed_class_weights(spark: SparkSession, d: str) -> DataFrame:
    """GEN-23: inverse frequencies to the power 0.25."""
    return E.class_weights(read(spark, d, "events"), "event_type")


SCORED = "(select doc_id, lang, source, n_chars, least(100.0, 40 + 60 * (length(text) - length(replace(text, ' ', '')) + 1) * 5.5 / (30 + n_chars)) as score from documents)"


def _scored(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a score from 40 to 100: how often there is a space.  It is cheap, as filters compute it again."""
    spaces = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))
    score = F.least(F.lit(100.0), 40 + 60 * (spaces + 1) * 5.5 / (30 + F.col("n_chars")))
    return read(spark, d, "documents").select("doc_id", "lang", "source", "n_chars", score.alias("score"))


GRADE = "case when score >= 90 then 'A' when score >= 80 then 'B' when score >= 70 then 'C' when score >= 60 then 'D' else 'F' end"
DECIDE = "case when n_chars < 60 or score < 75 or doc_id % 17 = 0 then 'DISCARD' when doc_id % 5 = 0 then 'NEEDS_REVISION' when score >= 80 then 'PASS' else 'NEEDS_REVISION' end"


def _decided(df: DataFrame) -> DataFrame:
    short = (F.col("n_chars") < 60).cast("int")
    return df.withColumn("decision", A.decision(F.col("score"), F.col("doc_id") % 17 == 0, F.col("doc_id") % 5 == 0, short))


@query(f"select doc_id, round(score, 6) as score, {GRADE} as grade from {SCORED}")
def grade_bands(spark: SparkSession, d: str) -> DataFrame:
    """SCR-1: grades by score."""
    return _scored(spark, d).select("doc_id", F.round("score", 6).alias("score"), A.grade(F.col("score")).alias("grade"))


@query(f"select doc_id, {DECIDE} as decision from {SCORED}")
def decision_rule(spark: SparkSession, d: str) -> DataFrame:
    """SCR-12: decisions from scores and issues."""
    return _decided(_scored(spark, d)).select("doc_id", "decision")


@query(f"""select doc_id, round(case when doc_id % 2 = 0 then 0.25 * score + 0.35 * (100 - doc_id % 40) + 0.25 * (doc_id % 101) + 0.15 * 90 else 0.6 * score + 0.4 * (100 - doc_id % 40) end, 6) as deterministic,
round(0.4 * (case when doc_id % 2 = 0 then 0.25 * score + 0.35 * (100 - doc_id % 40) + 0.25 * (doc_id % 101) + 0.15 * 90 else 0.6 * score + 0.4 * (100 - doc_id % 40) end) + 0.6 * (doc_id % 100), 6) as overall from {SCORED}""")
def composite_score(spark: SparkSession, d: str) -> DataFrame:
    """SCR-10, SCR-11: composite and hybrid scores."""
    i = F.col("doc_id")
    det = A.composite(F.col("score"), 100 - i % 40, i % 101, F.lit(90), i % 2 == 0)
    return _scored(spark, d).select("doc_id", F.round(det, 6).alias("deterministic"), F.round(A.hybrid(det, i % 100), 6).alias("overall"))


@query(f"""select source, count(*) n, round(avg(score), 6) as mean_score, case max(case {DECIDE} when 'DISCARD' then 2 when 'NEEDS_REVISION' then 1 else 0 end) when 2 then 'DISCARD' when 1 then 'NEEDS_REVISION' else 'PASS' end as worst,
count(*) filter ({DECIDE} <> 'PASS') as issues from {SCORED} group by source""")
def rollup_worst_decision(spark: SparkSession, d: str) -> DataFrame:
    """AGG-13, AGG-12: chunk reports rolled up to documents (here: documents to sources)."""
    rows = _decided(_scored(spark, d))
    issues = F.count_if(F.col("decision") != "PASS")
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("mean_score"), A.worst(F.col("decision")).alias("worst"), issues.alias("issues"))


@query(f"select source, doc_id, (doc_id % 10) || ':' || {DECIDE} as issue from {SCORED} where {DECIDE} <> 'PASS'")
def rollup_issues(spark: SparkSession, d: str) -> DataFrame:
    """AGG-13: all issues of the chunks under their document, one row each, so that no document's list must fit in memory."""
    return _decided(_scored(spark, d)).where("decision <> 'PASS'").select("source", "doc_id", F.concat((F.col("doc_id") % 10).cast("string"), F.lit(":"), "decision").alias("issue"))


@query(f"""select lang, count(*) n, round(avg(score), 2) as mean_score, round(100 * count(*) filter (where d = 'PASS') / count(*), 1) as pass_rate, count(*) filter (where d = 'PASS') as passed, count(*) filter (where d = 'NEEDS_REVISION') as revise, count(*) filter (where d = 'DISCARD') as discarded
from (select lang, score, {DECIDE} d from {SCORED}) group by rollup (lang)""")
def category_scorecard(spark: SparkSession, d: str) -> DataFrame:
    """AGG-32, AGG-14: scorecard by language and over all."""
    return A.scorecard(_decided(_scored(spark, d)), "lang", "score", "decision")


PENALTIES = """(values ('unannotated_question', 50, 20, 10, 60), ('stimulus_missing_citation', 25, 12, 5, 25), ('stimulus_nesting', 100, 50, 20, 100), ('single_question_stimulus', 20, 10, 5, 20),
('stimulus_anchor_invalid', 30, 15, 5, 35), ('stimulus_invalid', 30, 15, 5, 35), ('broken_system_tag', 40, 15, 5, 50), ('missing_question_label', 30, 15, 5, 40), ('missing_stem', 35, 15, 5, 35),
('missing_options', 35, 15, 5, 40), ('absorbed_subquestions', 30, 15, 5, 30), ('mislabelled_element', 30, 15, 5, 35), ('prohibited_tags', 40, 20, 5, 40), ('truncated_output', 50, 25, 10, 60),
('xml_syntax', 40, 15, 5, 50), ('schema_conformance', 30, 10, 5, 30), ('stimulus', 30, 15, 5, 35), ('question_structure', 40, 15, 5, 40), ('option_structure', 35, 15, 5, 35), ('verbatim_fidelity', 40, 15, 5, 40),
('conflict_markers', 100, 50, 20, 35), ('llm_semantic', 30, 15, 5, 30), ('odd', 30, 15, 5, 35)) as p(category, critical, major, minor, cap)"""
ISSUES = f"""(select user_id, event_id, category, severity, cap, cast(case severity when 'INFO' then 0 when 'CRITICAL' then critical when 'MAJOR' then major when 'MINOR' then minor else 5 end as double) p
from (select *, (select list(category order by category) from {PENALTIES})[cast((event_id // 5) % 23 as integer) + 1] as category, ['INFO', 'MINOR', 'MAJOR', 'CRITICAL', 'ODD'][cast(event_id % 5 as integer) + 1] as severity from events) join {PENALTIES} using (category))"""


def _issues(spark: SparkSession, d: str) -> DataFrame:
    """Issues made of events: all categories and one unknown one, all severities and one unknown one."""
    e = F.col("event_id")
    category = F.element_at(F.array(*map(F.lit, sorted([*A.PENALTIES, "odd"]))), (F.floor(e / 5) % 23 + 1).cast("int"))
    severity = F.element_at(F.array(*map(F.lit, (*A.SEVERITIES, "ODD"))), (e % 5 + 1).cast("int"))
    return read(spark, d, "events").select("user_id", "event_id", category.alias("category"), severity.alias("severity"))


@query(f"""select user_id, sum(p) as total, coalesce(sum(p) filter (severity = 'CRITICAL'), 0) as critical, coalesce(sum(p) filter (severity = 'MAJOR'), 0) as major, coalesce(sum(p) filter (severity = 'MINOR'), 0) as minor from {ISSUES} group by user_id""")
def penalty_pivot(spark: SparkSession, d: str) -> DataFrame:
    """AGG-29: penalties by document and severity."""
    rows = _issues(spark, d).withColumn("p", A.penalty(F.col("category"), F.col("severity")))
    by = lambda s: F.coalesce(F.sum(F.when(F.col("severity") == s, F.col("p"))), F.lit(0.0))
    return rows.groupBy("user_id").agg(F.sum("p").alias("total"), by("CRITICAL").alias("critical"), by("MAJOR").alias("major"), by("MINOR").alias("minor"))


@query(f"""with s as (select user_id, category, cap, sum(p) t from {ISSUES} group by all)
select user_id, round(greatest(0, 100 - sum(cap * (1 - exp(-t / greatest(1.0, cap * greatest(1.0, sqrt((user_id % 40) / 10.0))))))), 6) as score from s group by user_id""")
def adaptive_penalty(spark: SparkSession, d: str) -> DataFrame:
    """AGG-30: penalties that saturate by category."""
    rows = _issues(spark, d).groupBy("user_id", "category").agg(F.sum(A.penalty(F.col("category"), F.col("severity"))).alias("t"))
    return rows.groupBy("user_id").agg(F.round(F.greatest(F.lit(0.0), 100 - F.sum(A.adaptive(F.col("t"), A.cap(F.col("category")), F.col("user_id") % 40))), 6).alias("score"))


#: Pages whose web tags stand for page markup and annotations.
MARKED = "(select page_id, replace(replace(replace(replace(replace(replace(html, '<script', '<think'), '</script', '</think'), '<li>', '<page p=\"1\">'), '</li>', '</page>'), '<style>', '<page_metadata>'), '</style>', '</page_metadata>') html from pages)"


@query(f"""select page_id, cast(greatest(0, 100 - 20 * (least(3, len(regexp_extract_all(html, '(?i)</?pages(?:\\s+[^>]*)?>'))) + least(3, len(regexp_extract_all(html, '(?i)</?page(?:\\s+[^>]*)?>'))) + least(3, len(regexp_extract_all(html, '(?i)</?page_metadata(?:\\s+[^>]*)?>'))) + least(3, len(regexp_extract_all(html, '(?i)</?think(?:\\s+[^>]*)?>'))))) as bigint) as score from {MARKED}""")
def prohibited_tags_score(spark: SparkSession, d: str) -> DataFrame:
    """SCR-4: twenty points for each prohibited tag, three of a kind at most."""
    return _marked(spark, d).select("page_id", A.prohibited_score(F.col("html")).cast("long").alias("score"))


def _marked(spark: SparkSession, d: str) -> DataFrame:
    html = F.col("html")
    for a, b in (("<script", "<think"), ("</script", "</think"), ("<li>", '<page p="1">'), ("</li>", "</page>"), ("<style>", "<page_metadata>"), ("</style>", "</page_metadata>")):
        html = F.replace(html, F.lit(a), F.lit(b))
    return read_texts(spark, d, "pages").select("page_id", html.alias("html"))


@query("""with t as (select page_id, lower(tag) tag from (select page_id, unnest(regexp_extract_all(html, '<([A-Za-z][A-Za-z0-9]*)', 1)) tag from pages)) select tag, count(*) n, count(distinct page_id) pages from t group by tag""")
def html_tag_census(spark: SparkSession, d: str) -> DataFrame:
    """AGG-4: tags and the pages that have them."""
    tags = read(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit("<([A-Za-z][A-Za-z0-9]*)"), F.lit(1))).alias("tag"))
    return tags.groupBy(F.lower("tag").alias("tag")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("page_id").alias("pages"))


BALANCE = "(select page_id, tag, sum(o) opens, sum(c) closes from (select page_id, lower(unnest(regexp_extract_all(html, '<([A-Za-z][A-Za-z0-9]*)', 1))) tag, 1 o, 0 c from pages union all select page_id, lower(unnest(regexp_extract_all(html, '</([A-Za-z][A-Za-z0-9]*)', 1))), 0, 1 from pages) where tag not in ('br', 'hr', 'img', 'input', 'meta', 'link') group by 1, 2)"


@query(f"select page_id, tag, cast(opens as bigint) as opens, cast(closes as bigint) as closes, cast(opens - closes as bigint) as unclosed from {BALANCE} where opens <> closes")
def html_open_close_balance(spark: SparkSession, d: str) -> DataFrame:
    """SCR-2, SCR-19: tags that open and close unequally often."""
    return _balance(spark, d).where("unclosed <> 0")


def _balance(spark: SparkSession, d: str) -> DataFrame:
    found = F.regexp_extract_all("html", F.lit("</?[A-Za-z][A-Za-z0-9]*"), F.lit(0))
    tags = read(spark, d, "pages").select("page_id", F.explode(found).alias("t"))
    tags = tags.select("page_id", F.lower(F.regexp_replace("t", "^</?", "")).alias("tag"), F.col("t").startswith("</").alias("close")).where(~F.col("tag").isin(*X.VOID_TAGS))
    opens, closes = F.count_if(~F.col("close")), F.count_if(F.col("close"))
    return tags.groupBy("page_id", "tag").agg(opens.alias("opens"), closes.alias("closes"), (opens - closes).alias("unclosed"))


@query(f"select page_id, greatest(0, 100 - 10 * cast(coalesce(sum(case when opens <> closes then abs(opens - closes) else 0 end), 0) as bigint)) as syntax_score from {BALANCE} group by page_id")
def xml_syntax_counts(spark: SparkSession, d: str) -> DataFrame:
    """SCR-2: ten points for each tag left open or closed without need."""
    return _balance(spark, d).groupBy("page_id").agg(F.greatest(F.lit(0), 100 - 10 * F.sum(F.abs("unclosed"))).alias("syntax_score"))


@query(r"""select doc_id, round(0.4 * least(1.0, greatest(0.0, n_chars / 3000.0)) + 0.25 * (case when doc_id % 3 = 0 then 0 else 1 end) + 0.15 * (case when doc_id % 2 = 0 then 1.0 else 0.5 end)
+ 0.1 * least(1.0, least(doc_id % 500, 500 - doc_id % 500) / (500 * 0.2 + 1e-5)) + 0.1 * least(1.0, (doc_id % 4) * 0.5), 6) as quality from documents""")
def span_candidate_quality(spark: SparkSession, d: str) -> DataFrame:
    """SCR-15: quality of candidate spans."""
    i = F.col("doc_id")
    q = A.span_quality(F.col("n_chars") / 3000.0, i % 3 != 0, i % 2 == 0, i % 500, F.lit(500), i % 4)
    return read(spark, d, "documents").select("doc_id", F.round(q, 6).alias("quality"))


@query("select doc_id, length(text) + length(source) + case when doc_id % 2 = 0 then 20 else 0 end + 5 * least(doc_id % 14, 10) + case when doc_id % 3 = 0 then 3 else 0 end as quality from documents")
def question_quality(spark: SparkSession, d: str) -> DataFrame:
    """SCR-16: completeness of a question: texts, explanation, options, answer."""
    i = F.col("doc_id")
    q = F.length("text") + F.length("source") + F.when(i % 2 == 0, 20).otherwise(0) + 5 * F.least(i % 14, F.lit(10)) + F.when(i % 3 == 0, 3).otherwise(0)
    return read(spark, d, "documents").select("doc_id", q.cast("long").alias("quality"))


@query("select user_id, cast(case when n = 0 then 0.0 when dup * 4 > n then 0.5 when n > 10 and opts = 0 then 0.85 else 0.9 end as double) as confidence from (select user_id, count(*) n, count(*) - count(distinct event_type || cast(value as integer)) dup, count(*) filter (where event_type = 'purchase') opts from events group by user_id)")
def parse_confidence(spark: SparkSession, d: str) -> DataFrame:
    """SCR-17: confidence of a parse from duplicates and questions without options."""
    n, dup = F.count(F.lit(1)), F.count(F.lit(1)) - F.countDistinct(F.concat("event_type", F.rint("value").cast("int").cast("string")))
    opts = F.count_if(F.col("event_type") == "purchase")
    return read(spark, d, "events").groupBy("user_id").agg(F.when(n == 0, 0.0).when(dup * 4 > n, 0.5).when((n > 10) & (opts == 0), 0.85).otherwise(0.9).alias("confidence"))


@query(r"""with s as (select doc_id, i, unnest(ls) l from (select doc_id, string_split(text, '.') ls, unnest([0]) i from documents)), n as (select doc_id, l, row_number() over (partition by doc_id order by i) r from s)
select doc_id, count(*) as n, cast(sum(1 + case when regexp_matches(l, '\?') then 2 else 0 end + case when regexp_matches(l, '(?i)^\s*(what|which|when|where|who|why|how|that|the)\b') then 1 else 0 end + case when regexp_matches(l, '_{3,}|-{3,}') then 1 else 0 end) as bigint) as score from n group by doc_id""")
def regex_candidate_score(spark: SparkSession, d: str) -> DataFrame:
    """SCR-18: sentences scored as question candidates."""
    s = read(spark, d, "documents").select("doc_id", F.explode(F.split("text", r"\.")).alias("l"))
    hit = lambda p, v: F.when(F.col("l").rlike(p), v).otherwise(0)
    score = 1 + hit(r"\?", 2) + hit(r"(?i)^\s*(what|which|when|where|who|why|how|that|the)\b", 1) + hit("_{3,}|-{3,}", 1)
    return s.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(score).alias("score"))


@query("""with c as (select user_id, event_id, case event_type when 'click' then 2 when 'view' then 1 else 0 end as tier, value from events) select user_id, arg_max(event_id, {'t': tier, 'v': value, 'e': -event_id}) as best from c group by user_id""")
def candidate_rank(spark: SparkSession, d: str) -> DataFrame:
    """SCR-14: the best candidate by decision and score."""
    tier = F.when(F.col("event_type") == "click", 2).when(F.col("event_type") == "view", 1).otherwise(0)
    return read(spark, d, "events").groupBy("user_id").agg(F.max_by("event_id", F.struct(tier.alias("t"), F.col("value").alias("v"), (-F.col("event_id")).alias("e"))).alias("best"))


@query("""select doc_id, case when doc_id % 7 = 0 and score < 68 then 68.0 else round(score, 6) end as score, case when doc_id % 7 <> 0 and score >= 88 and doc_id % 11 = 0 then 'PASS' when score >= 80 then 'PASS' when score >= 60 then 'NEEDS_REVISION' else 'DISCARD' end as decision from """ + SCORED)
def legacy_decision(spark: SparkSession, d: str) -> DataFrame:
    """SCR-13: a floor for large documents, and a bypass for isolated defects."""
    i, s = F.col("doc_id"), F.col("score")
    kept = F.when((i % 7 == 0) & (s < 68), 68.0).otherwise(F.round(s, 6))
    chosen = F.when((i % 7 != 0) & (s >= 88) & (i % 11 == 0), "PASS").when(s >= 80, "PASS").when(s >= 60, "NEEDS_REVISION").otherwise("DISCARD")
    return _scored(spark, d).select("doc_id", kept.alias("score"), chosen.alias("decision"))


@query(f"""select doc_id, decision, coalesce(case when retention < 0.75 then 'low retention' end, case when omitted >= 10 then 'omissions' end, case when decision = 'DISCARD' and doc_id % 17 = 0 then 'critical' end, 'recoverable') as reason
from (select doc_id, {DECIDE} decision, n_chars / (n_chars + doc_id % 900.0) as retention, doc_id % 13 as omitted from {SCORED})""")
def unrecoverable_discard(spark: SparkSession, d: str) -> DataFrame:
    """FLT-8: the first reason why a document cannot be repaired."""
    i = F.col("doc_id")
    reason = F.coalesce(F.when(F.col("n_chars") / (F.col("n_chars") + i % 900) < 0.75, "low retention"), F.when(i % 13 >= 10, "omissions"), F.when((F.col("decision") == "DISCARD") & (i % 17 == 0), "critical"), F.lit("recoverable"))
    return _decided(_scored(spark, d)).select("doc_id", "decision", reason.alias("reason"))


@query(f"select doc_id, score, decision from (select doc_id, round(score, 6) score, {DECIDE} decision from {SCORED}) where decision = 'PASS' and score >= 85")
def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    """FLT-1: chunks for training: passed, and 85 or more."""
    return _decided(_scored(spark, d)).where("decision = 'PASS' and score >= 85").select("doc_id", F.round("score", 6).alias("score"), "decision")


@query(f"""with c as (select source, doc_id, score, {DECIDE} d from {SCORED}), k as (select doc_id, 'chunk' lvl from c where d = 'PASS' and score >= 91),
f as (select min(doc_id) doc_id, 'document' lvl from c where source not in (select source from c where d = 'PASS' and score >= 91) group by source having avg(score) >= 60) select * from k union all select * from f""")
def quality_gate_fallback(spark: SparkSession, d: str) -> DataFrame:
    """FLT-2: whole documents only where none of their chunks passed."""
    rows = _decided(_scored(spark, d))
    kept = rows.where("decision = 'PASS' and score >= 91")
    rest = rows.join(kept.select("source").distinct(), "source", "left_anti").groupBy("source").agg(F.min("doc_id").alias("doc_id"), F.avg("score").alias("m")).where("m >= 60")
    return kept.select("doc_id", F.lit("chunk").alias("lvl")).unionAll(rest.select("doc_id", F.lit("document").alias("lvl")))


@query(f"select doc_id from (select doc_id, {DECIDE} d from {SCORED}) where d in ('DISCARD', 'NEEDS_REVISION')")
def decision_alias_filter(spark: SparkSession, d: str) -> DataFrame:
    """FLT-7: FAILED stands for DISCARD and NEEDS_REVISION."""
    wanted = [x for name in ("FAILED",) for x in {"FAILED": ("DISCARD", "NEEDS_REVISION")}.get(name, (name,))]
    return _decided(_scored(spark, d)).where(F.col("decision").isin(*wanted)).select("doc_id")


@query("""select event_id from events where not regexp_matches(props, '"k": 1\\d') and event_type <> 'error'""")
def spurious_issue_filter(spark: SparkSession, d: str) -> DataFrame:
    """FLT-13: issues that complain of a known artefact go."""
    return read(spark, d, "events").where(~F.col("props").rlike(r'"k": 1\d') & (F.col("event_type") != "error")).select("event_id")


@query("""with g as (select 'w' label, doc_id, unnest(range(0, 3)) k from documents), p as (select 'w' label, doc_id, unnest(range(0, 3)) k2 from documents where lang <> 'de'),
a as (select label, doc_id, k s, count(*) a from g group by all), b as (select label, doc_id, k2 + (doc_id % 2) s, count(*) b from p group by all)
select label, cast(sum(least(coalesce(a, 0), coalesce(b, 0))) as bigint) tp, cast(sum(greatest(coalesce(b, 0) - coalesce(a, 0), 0)) as bigint) fp, cast(sum(greatest(coalesce(a, 0) - coalesce(b, 0), 0)) as bigint) fn from a full join b using (label, doc_id, s) group by label""")
def span_match_exact(spark: SparkSession, d: str) -> DataFrame:
    """JN-20: gold and predicted spans as multisets of bounds."""
    docs = read(spark, d, "documents").select("doc_id", "lang", F.lit("w").alias("label"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k"))
    return E.multiset_match(docs.select("doc_id", "label", F.col("k").alias("s")), docs.where("lang <> 'de'").select("doc_id", "label", (F.col("k") + F.col("doc_id") % 2).alias("s")), ["label", "doc_id", "s"])


@query("""select doc_id, least(g1, p1) - greatest(g0, p0) as inter, round(greatest(0, least(g1, p1) - greatest(g0, p0)) / cast(g1 - g0 + p1 - p0 - greatest(0, least(g1, p1) - greatest(g0, p0)) as double), 6) as iou
from (select doc_id, 0 g0, n_chars g1, n_chars // 4 p0, n_chars + 10 p1 from documents)""")
def char_mask_metrics(spark: SparkSession, d: str) -> DataFrame:
    """AGG-8, SET-3: overlap of character ranges by interval arithmetic, without a row per character."""
    n = F.col("n_chars")
    p0, p1 = F.floor(n / 4), n + 10
    inter = F.least(n, p1) - p0
    both = F.greatest(inter, F.lit(0))
    return read(spark, d, "documents").select("doc_id", inter.alias("inter"), F.round(both / (n + p1 - p0 - both).cast("double"), 6).alias("iou"))


@query("""with x as (select label, i, avg(v) v from (select label, generate_subscripts(embedding, 1) i, cast(unnest(embedding) as double) v from embeddings) group by 1, 2), n as (select label, sqrt(sum(v * v)) n from x group by 1)
select a.label as a, b.label as b, round(case when na.n * nb.n = 0 then 0 else sum(a.v * b.v) / (na.n * nb.n) end, 6) as cosine, round(sqrt(sum((a.v - b.v) * (a.v - b.v))), 6) as distance
from x a join x b on a.i = b.i and a.label < b.label join n na on na.label = a.label join n nb on nb.label = b.label group by a.label, b.label, na.n, nb.n""")
def centroid_cosine(spark: SparkSession, d: str) -> DataFrame:
    """AGG-22: cosines and distances of mean vectors."""
    x = read(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "v")).groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("v"))
    v = x.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("c"))  # one short row per label
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, y: s + y)
    a, b = v.select(F.col("label").alias("a"), F.col("c").alias("x")), v.select(F.col("label").alias("b"), F.col("c").alias("y"))
    pairs = a.join(b, F.col("a") < F.col("b"))
    norm = F.sqrt(dot("x", "x")) * F.sqrt(dot("y", "y"))
    gap = F.aggregate(F.zip_with("x", "y", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, z: s + z)
    return pairs.select("a", "b", F.round(F.when(norm == 0, 0.0).otherwise(dot("x", "y") / norm), 6).alias("cosine"), F.round(F.sqrt(gap), 6).alias("distance"))


VECTOR = r"""(select page_id, cast(len(regexp_extract_all(html, '<p[ >]')) as double) f0, cast(len(regexp_extract_all(html, '<a[ >]')) as double) f1, cast(len(regexp_extract_all(html, '<li[ >]')) as double) f2, cast(length(html) as double) / 1000 f3, cast(len(regexp_extract_all(html, '<[a-z]')) as double) / greatest(length(html), 1) f4 from pages)"""


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    count = lambda p: F.regexp_count("html", F.lit(p)).cast("double")
    size = F.length("html")
    return read(spark, d, "pages").select("page_id", count("<p[ >]").alias("f0"), count("<a[ >]").alias("f1"), count("<li[ >]").alias("f2"), (size.cast("double") / 1000).alias("f3"), (count("<[a-z]") / F.greatest(size, F.lit(1))).alias("f4"))


@query(f"select page_id, f0, f1, f2, round(f3, 6) as f3, round(f4, 6) as f4 from {VECTOR}")
def structural_vector(spark: SparkSession, d: str) -> DataFrame:
    """AGG-23: structural features."""
    return _vectors(spark, d).select("page_id", "f0", "f1", "f2", F.round("f3", 6).alias("f3"), F.round("f4", 6).alias("f4"))


@query("select page_id, " + ", ".join(f"round((f{i} - avg(f{i}) over ()) / (stddev_pop(f{i}) over () + 1e-6), 5) as z{i}" for i in range(5)) + f" from {VECTOR}")
def zscore_vector(spark: SparkSession, d: str) -> DataFrame:
    """AGG-24: standardised features; the moments are one aggregated row, not a window over all."""
    v = _vectors(spark, d)
    moments = v.agg(*[F.avg(f"f{i}").alias(f"m{i}") for i in range(5)], *[F.stddev_pop(f"f{i}").alias(f"s{i}") for i in range(5)])
    joined = v.crossJoin(F.broadcast(moments))  # one row
    return joined.select("page_id", *[F.round((F.col(f"f{i}") - F.col(f"m{i}")) / (F.col(f"s{i}") + 1e-6), 5).alias(f"z{i}") for i in range(5)])


@query(r"""with t as (select page_id, i, lower(t) t from (select page_id, generate_subscripts(ts, 1) i, unnest(ts) t from (select page_id, regexp_extract_all(html, '<([A-Za-z][A-Za-z0-9]*)', 1) ts from pages))), p as (select t a, lead(t) over (partition by page_id order by i) b from t)
select a, b, count(*) n, round(count(*) / sum(count(*)) over (partition by a), 6) as p from p where b is not null group by a, b""")
def tag_bigrams(spark: SparkSession, d: str) -> DataFrame:
    """AGG-23: how often a tag follows another; neighbours come from the array itself, without a window."""
    pages = read(spark, d, "pages").select(F.transform(F.regexp_extract_all("html", F.lit("<([A-Za-z][A-Za-z0-9]*)"), F.lit(1)), lambda t: F.lower(t)).alias("t"))
    pairs = pages.where(F.size("t") > 1).select(F.explode(F.arrays_zip(F.slice("t", F.lit(1), F.size("t") - 1).alias("a"), F.slice("t", F.lit(2), F.size("t")).alias("b"))).alias("p")).select("p.a", "p.b")
    n = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    return n.select("a", "b", "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("a")), 6).alias("p"))
