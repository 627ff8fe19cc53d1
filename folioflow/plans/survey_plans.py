"""Queries of one operator each: question intervals, orders, signatures, candidates, readers and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.operators import documents as D
from folioflow.operators import questions as Q
from folioflow.operators import spans as S
from folioflow.operators import synthetic as G
from folioflow.registry import query, read, read_texts
from folioflow.sources import readers, writers

LABELS = ("question_label", "stem", "option_label", "option_text", "option_label", "option_text", "explanation", "section")
SPANS = """(select conv_id, s as start, s + length(text) as "end", ['question_label', 'stem', 'option_label', 'option_text', 'option_label', 'option_text', 'explanation', 'section'][cast((turn + conv_id) % 8 as integer) + 1] as label from (select *, cast(turn * 5000 as bigint) s from conversations))"""
UNDER = f"""u as (select *, coalesce(lead(start) over (partition by conv_id order by start), 1000000000) nxt from {SPANS} where label = 'question_label')"""


def _spans(spark: SparkSession, d: str) -> DataFrame:
    """Turns as spans, whose labels go round."""
    start = (F.col("turn") * 5000).cast("long")
    label = F.element_at(F.array(*map(F.lit, LABELS)), ((F.col("turn") + F.col("conv_id")) % 8 + 1).cast("int"))
    return read(spark, d, "conversations").select("conv_id", start.alias("start"), (start + F.length("text")).alias("end"), label.alias("label"))


def _first_sql(label: str) -> str:
    return f"""with {UNDER} select u.conv_id, u.start as q, min(s.start) as start, arg_min(s."end", s.start) as "end" from u left join (select * from {SPANS} where label = '{label}') s on s.conv_id = u.conv_id and s.start >= u."end" and s.start < u.nxt group by 1, 2"""


@query(_first_sql("stem"))
def question_stem(spark: SparkSession, d: str) -> DataFrame:
    """JN-9: the first stem between a question label's end and the next question label."""
    return Q.first_of(Q.under_labels(_spans(spark, d), "conv_id"), "conv_id", "stem")


@query(_first_sql("explanation"))
def question_explanation(spark: SparkSession, d: str) -> DataFrame:
    """JN-11: the first explanation between a question label's end and the next question label."""
    return Q.first_of(Q.under_labels(_spans(spark, d), "conv_id"), "conv_id", "explanation")


@query(f"""with {UNDER}, o as (select u.conv_id, u.start q, u.nxt, l.start o, l."end" o_end from u join (select * from {SPANS} where label = 'option_label') l on l.conv_id = u.conv_id and l.start >= u.start and l.start < u.nxt),
p as (select *, least(nxt, coalesce(lead(o) over (partition by conv_id, q order by o), 1000000000)) stop from o)
select p.conv_id, q, o, min(t.start) as start, arg_min(t."end", t.start) as "end" from p left join (select * from {SPANS} where label = 'option_text') t on t.conv_id = p.conv_id and t.start >= p.o_end and t.start < p.stop group by 1, 2, 3""")
def question_options(spark: SparkSession, d: str) -> DataFrame:
    """JN-8: option labels of each question with the text before the next label."""
    return Q.options(Q.under_labels(_spans(spark, d), "conv_id"), "conv_id")


OBJECTS = "(select conv_id, turn as place, case when turn % 11 = 6 then 'section' when turn % 3 = 0 then 'stimulus' else 'question' end as kind, case when (conv_id + turn) % 2 = 0 and turn % 3 = 0 then [turn + 1, turn + 5, turn + 8] else [] end as listed from conversations)"


@query(f"""with o as (select * from {OBJECTS}), q as (select conv_id, place from o where kind = 'question'), l as (select conv_id, place s, unnest(listed) p from o where kind = 'stimulus'),
x as (select q.conv_id, q.place, arg_min(l.s, (abs(q.place - l.s), l.s)) s from q join l on l.conv_id = q.conv_id and l.p = q.place and abs(q.place - l.s) <= 6 group by 1, 2),
a as (select q.conv_id, q.place, max(o.place) e from q join o on o.conv_id = q.conv_id and o.kind <> 'question' and o.place <= q.place group by 1, 2)
select q.conv_id, q.place as question, coalesce(x.s, case when o.kind = 'stimulus' and len(o.listed) = 0 then o.place end) as stimulus from q left join x using (conv_id, place) left join a using (conv_id, place) left join o on o.conv_id = q.conv_id and o.place = a.e""")
def served_questions(spark: SparkSession, d: str) -> DataFrame:
    """JN-12: the stimulus of each question, by its list within six pages or as the active one."""
    turn, conv = F.col("turn"), F.col("conv_id")
    kind = F.when(turn % 11 == 6, "section").when(turn % 3 == 0, "stimulus").otherwise("question")
    listed = F.when(((conv + turn) % 2 == 0) & (turn % 3 == 0), F.array(turn + 1, turn + 5, turn + 8)).otherwise(F.array().cast("array<long>"))
    return Q.served(read(spark, d, "conversations").select("conv_id", turn.alias("place"), kind.alias("kind"), listed.alias("listed")), "conv_id")


RANK = "coalesce(nullif(list_position(['section', 'stimulus', 'question_label', 'stem', 'option_label', 'option_text', 'explanation'], label), 0), 99)"
NESTED = """(select conv_id, cast(turn // 3 * 10 as bigint) as start, cast(turn // 3 * 10 + turn % 4 * 5 as bigint) as "end", ['section', 'stimulus', 'stem', 'other', 'option_text'][cast((turn * 3 + conv_id) % 5 as integer) + 1] as label, turn % 7 = 6 as self from conversations)"""


def _nested(spark: SparkSession, d: str) -> DataFrame:
    turn, at = F.col("turn"), (F.floor(F.col("turn") / 3) * 10).cast("long")
    label = F.element_at(F.array(*map(F.lit, ("section", "stimulus", "stem", "other", "option_text"))), ((turn * 3 + F.col("conv_id")) % 5 + 1).cast("int"))
    return read(spark, d, "conversations").select("conv_id", at.alias("start"), (at + turn % 4 * 5).alias("end"), label.alias("label"), (turn % 7 == 6).alias("self"))


@query(f"""select conv_id, row_number() over (partition by conv_id order by start, -"end", {RANK}, label, self) as place, start, "end", label from {NESTED}""")
def span_order(spark: SparkSession, d: str) -> DataFrame:
    """ORD-1: spans by start, longer first, outer labels first."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("start", -F.col("end"), Q.priority(F.col("label")), "label", "self"))
    return _nested(spark, d).select("conv_id", place.alias("place"), "start", "end", "label")


@query(f"""with t as (select conv_id, label, start as "at", 1 kind, 0 extent, {RANK} r from {NESTED} where self union all select conv_id, label, start, 2, -"end", {RANK} from {NESTED} where not self union all select conv_id, label, "end", 0, -start, -{RANK} from {NESTED} where not self)
select conv_id, row_number() over (partition by conv_id order by "at", kind, extent, r, label) as place, "at", kind, label from t""")
def tag_event_order(spark: SparkSession, d: str) -> DataFrame:
    """ORD-2: tags by offset, closing before self-closing before opening, inner before outer ones."""
    return Q.event_order(_nested(spark, d), "conv_id")


@query("""select conv_id, name, number, row_number() over (partition by conv_id order by number, name) as place from (select conv_id, name, coalesce(try_cast(regexp_extract(name, 'chunk_(\\d+)', 1) as integer), 999) as number from (select conv_id, case when turn % 6 = 5 then 'merged_' || turn else 'doc_chunk_' || (turn * 7 % 13) end as name from conversations))""")
def chunk_natural_sort(spark: SparkSession, d: str) -> DataFrame:
    """ORD-3: chunks by the number in their name, 999 where there is none."""
    t = F.col("turn")
    name = F.when(t % 6 == 5, F.concat(F.lit("merged_"), t)).otherwise(F.concat(F.lit("doc_chunk_"), t * 7 % 13))
    number = F.coalesce(F.regexp_extract(name, r"chunk_(\d+)", 1).try_cast("int"), F.lit(999))
    rows = read(spark, d, "conversations").select("conv_id", name.alias("name"), number.alias("number"))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy("number", "name")))


@query("""with c as (select user_id, event_type, ts, event_id, cast(json_extract_string(props, '$.k') as bigint) // 8 as o from events), l as (select *, lag(o) over (partition by user_id, event_type order by ts, event_id) p from c),
g as (select user_id, event_type, count(*) n, round(4.0 * count(*) filter (where o = p + 1) / greatest(count(*) - 1, 1) + 3.0 * count(distinct o) / (max(o) - min(o) + 1) + least(count(*), 40) * 0.2 + case when event_type in ('click', 'view') then 5 else 0 end
+ case when arg_min(o, (ts, event_id)) in (1, 101, 201, 301, 401, 501, 601) then 2 else 0 end - 1.5 * count(*) filter (where o <= p), 6) score, min((ts, event_id)) first from l group by 1, 2)
select user_id, event_type as signature, n, score from (select *, row_number() over (partition by user_id order by score desc, first) r from g) where r = 1""")
def question_signature(spark: SparkSession, d: str) -> DataFrame:
    """AGG-19: the enumerator signature that numbers questions best; ties to the one that comes first."""
    c = read(spark, d, "events").select("user_id", F.col("event_type").alias("signature"), "ts", "event_id", F.floor(F.get_json_object("props", "$.k").cast("long") / 8).alias("o"))
    scores = Q.signature_scores(c, "user_id", "signature", ["ts", "event_id"], "o", F.col("signature").isin("click", "view"))
    best = F.min(F.struct((-F.col("score")).alias("s"), "first", "signature", "n")).alias("b")
    return scores.groupBy("user_id").agg(best).select("user_id", "b.signature", "b.n", (-F.col("b.s")).alias("score"))


RAW = "(select conv_id, string_agg('Q' || (turn + 1) || '. ' || replace(text, chr(10), ' '), chr(10) order by turn) raw from conversations group by conv_id)"


@query(rf"""with b as (select conv_id, unnest(regexp_extract_all(raw, '(?m)^Q(\d+)\. ', 1)) num, unnest(list_slice(regexp_split_to_array(raw, '(?m)^Q\d+\. '), 2, 100000)) block from {RAW})
select conv_id, cast(num as bigint) as number, trim(block, chr(10) || ' ') as block from b where not exists (select 1 from conversations c where c.conv_id = b.conv_id and c.turn + 1 = cast(num as bigint) and c.role = 'user')""")
def missing_questions(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-30: numbered blocks of the raw text whose number was not parsed, each up to the next number."""
    turns = read(spark, d, "conversations")
    line = F.concat(F.lit("Q"), F.col("turn") + 1, F.lit(". "), F.replace("text", F.lit("\n"), F.lit(" ")))
    raw = turns.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))), lambda r: r["l"]), "\n").alias("raw"))
    numbers, blocks = F.regexp_extract_all("raw", F.lit(r"(?m)^Q(\d+)\. "), F.lit(1)), F.split("raw", r"(?m)^Q\d+\. ")
    rows = raw.select("conv_id", F.explode(F.arrays_zip(numbers.alias("n"), F.slice(blocks, F.lit(2), F.greatest(F.size(blocks) - 1, F.lit(0))).alias("b"))).alias("x"))
    found = rows.select("conv_id", F.col("x.n").cast("long").alias("number"), F.btrim("x.b", F.lit("\n ")).alias("block"))
    parsed = turns.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("number"))
    return found.join(parsed, ["conv_id", "number"], "left_anti")


CANDIDATE = r"(?i)(?:^|\s)(?:(question|exercise|part|section)\s+)?([(\[])?(\d{1,4}|[a-z])([)\]])?([.:)/-])?(?:\s|$)"


@query(rf"""with m as (select doc_id, regexp_replace(regexp_replace('Question 1 is (a) or 2. ' || text, '\$[^$\n]*\$', ' ', 'g'), '`[^`\n]*`', ' ', 'g') t from documents),
c as (select doc_id, unnest(regexp_extract_all(t, '{CANDIDATE}', 1)) kw, unnest(regexp_extract_all(t, '{CANDIDATE}', 4)) ket, unnest(regexp_extract_all(t, '{CANDIDATE}', 5)) term from m)
select doc_id, count(*) as candidates, count(*) filter (where kw <> '' or ket <> '' or term <> '') as accepted from c group by doc_id""")
def candidate_acceptance(spark: SparkSession, d: str) -> DataFrame:
    """FLT-5: enumerators outside of formulas and code count as candidates if they have a keyword, a closing bracket or a terminator."""
    t = F.regexp_replace(F.regexp_replace(F.concat(F.lit("Question 1 is (a) or 2. "), "text"), r"\$[^$\n]*\$", " "), r"`[^`\n]*`", " ")
    rows = read_texts(spark, d).select("doc_id", t.alias("t"))
    part = lambda k: F.regexp_extract_all("t", F.lit(CANDIDATE), F.lit(k)).alias(f"g{k}")
    c = rows.select("doc_id", F.explode(F.arrays_zip(part(1), part(4), part(5))).alias("c"))
    return c.groupBy("doc_id").agg(F.count(F.lit(1)).alias("candidates"), F.count_if((F.col("c.g1") != "") | (F.col("c.g4") != "") | (F.col("c.g5") != "")).alias("accepted"))


NUMBERED = r"""(select conv_id, turn, role = 'user' as prefixed, case when turn % 4 = 3 then turn + 2 else turn end as number, text || case when turn % 3 = 0 then ' A. one B. two' when turn % 3 = 1 then ' A. one B. two C. three?' else ' ____' end as stem from conversations)"""
SIGNALS = r"""case when prefixed then 2 else 0 end + case when contains(stem, '?') then 2 else 0 end + case when regexp_matches(stem, '(?i)^\s*(?:what|which|when|where|who|why|how|que|qui|la|le|der|die)\s') then 1 else 0 end + case when regexp_matches(stem, '(?i)^\s*(?:choose|select|find|calculate|complete|explain)\s') then 1 else 0 end
+ case when n >= 2 then 2 else 0 end + case when n >= 3 then 1 else 0 end + case when regexp_matches(stem, '_{3,}|-{3,}|\.{3,}') then 1 else 0 end + case when coalesce(lag(number) over w + 1 = number, false) or coalesce(number + 1 = lead(number) over w, false) then 1 else 0 end"""


@query(f"""select conv_id, turn, cast(score as bigint) as score, score >= 3 as accepted from (select conv_id, turn, {SIGNALS} as score from (select *, len(regexp_extract_all(stem, ' [A-D]\\. ')) n from {NUMBERED}) window w as (partition by conv_id order by turn))""")
def question_candidates(spark: SparkSession, d: str) -> DataFrame:
    """SCR-18: signals of numbered candidates: prefix, question mark, interrogative, prompt, choices, blank, sequence; accepted from 3 on."""
    turn = F.col("turn")
    tail = F.when(turn % 3 == 0, " A. one B. two").when(turn % 3 == 1, " A. one B. two C. three?").otherwise(" ____")
    rows = read(spark, d, "conversations").select("conv_id", "turn", (F.col("role") == "user").alias("prefixed"), F.when(turn % 4 == 3, turn + 2).otherwise(turn).alias("number"), F.concat("text", tail).alias("stem"))
    w = Window.partitionBy("conv_id").orderBy("turn")
    hit = lambda c, v=1: F.when(c, v).otherwise(0)
    stem, n, number = F.col("stem"), F.regexp_count("stem", F.lit(r" [A-D]\. ")), F.col("number")
    beside = F.coalesce(F.lag(number).over(w) + 1 == number, F.lit(False)) | F.coalesce(number + 1 == F.lead(number).over(w), F.lit(False))
    score = hit(F.col("prefixed"), 2) + hit(stem.contains("?"), 2) + hit(stem.rlike(r"(?i)^\s*(?:what|which|when|where|who|why|how|que|qui|la|le|der|die)\s")) + hit(stem.rlike(r"(?i)^\s*(?:choose|select|find|calculate|complete|explain)\s"))
    score += hit(n >= 2, 2) + hit(n >= 3) + hit(stem.rlike(r"_{3,}|-{3,}|\.{3,}")) + hit(beside)
    return rows.select("conv_id", "turn", score.cast("long").alias("score"), (score >= 3).alias("accepted"))


@query("select doc_id, coalesce(nullif(s.subject, ''), '{}') as subject from documents left join (select 'src' || i as source, case when i % 3 = 0 then '' else 'subject' || i % 4 end as subject from range(15) t(i)) s using (source)")
def catalog_enrichment(spark: SparkSession, d: str) -> DataFrame:
    """JN-4: the subject of each document's source by a catalog of fixed size; an empty default where it is unknown."""
    i = F.col("id")
    known = spark.range(15).select(F.concat(F.lit("src"), i).alias("source"), F.when(i % 3 != 0, F.concat(F.lit("subject"), i % 4)).alias("subject"))
    return read(spark, d, "documents").join(F.broadcast(known), "source", "left").select("doc_id", F.coalesce("subject", F.lit("{}")).alias("subject"))


@query("select p.page_id, coalesce(m.kind, 'unknown') as modality from (select page_id, regexp_extract(url, '([^/]+)$', 1) stem from pages) p left join (select stem, case when count(*) > 1 then 'mixed' when min(page_id) % 2 = 0 then 'digital' else 'scanned' end kind from (select page_id, regexp_extract(url, '([^/]+)$', 1) stem from pages where page_id % 4 <> 3) group by stem) m using (stem)")
def modality_lookup(spark: SparkSession, d: str) -> DataFrame:
    """JN-22: the modality of each page by the stem of its name."""
    pages = read(spark, d, "pages").select("page_id", F.regexp_extract("url", "([^/]+)$", 1).alias("stem"))
    kind = F.when(F.count(F.lit(1)) > 1, "mixed").when(F.min("page_id") % 2 == 0, "digital").otherwise("scanned")
    known = pages.where("page_id % 4 <> 3").groupBy("stem").agg(kind.alias("kind"))
    return pages.join(known, "stem", "left").select("page_id", F.coalesce("kind", F.lit("unknown")).alias("modality"))


@query("select d.doc_id, coalesce(a.p, b.p, c.p) as path from documents d left join (select doc_id, 'a/' || doc_id p from labels where quality = 1) a using (doc_id) left join (select doc_id, 'b/' || doc_id p from labels where toxic = 1) b using (doc_id) left join (select doc_id, 'c/' || lang p from documents where n_chars > 3000) c using (doc_id) where d.n_chars < 500 or d.doc_id % 5 = 0 and coalesce(a.p, b.p, c.p) is not null")
def failure_targets(spark: SparkSession, d: str) -> DataFrame:
    """SRC-21: failed documents with the first of three source paths; long ones without any go."""
    docs, labels = read(spark, d, "documents"), read(spark, d, "labels")
    a = labels.where("quality = 1").select("doc_id", F.concat(F.lit("a/"), "doc_id").alias("a"))
    b = labels.where("toxic = 1").select("doc_id", F.concat(F.lit("b/"), "doc_id").alias("b"))
    rows = docs.where("n_chars < 500 or doc_id % 5 = 0").join(a, "doc_id", "left").join(b, "doc_id", "left")
    path = F.coalesce("a", "b", F.when(F.col("n_chars") > 3000, F.concat(F.lit("c/"), "lang")))
    return rows.withColumn("path", path).where("n_chars < 500 or path is not null").select("doc_id", "path")


@query("select event_id, coalesce(case when event_id % 3 = 0 then k end, coalesce(k, 0) + coalesce(case when event_id % 2 = 0 then user_id end, 0) + event_id % 7) as total_tokens from (select *, cast(json_extract_string(props, '$.k') as bigint) k from events)")
def usage_totals(spark: SparkSession, d: str) -> DataFrame:
    """SNK-6: totals of usage records: as given, else the sum of input, output and reasoning tokens."""
    e, k = F.col("event_id"), F.get_json_object("props", "$.k").cast("long")
    parts = F.coalesce(k, F.lit(0)) + F.coalesce(F.when(e % 2 == 0, F.col("user_id")), F.lit(0)) + e % 7
    return read(spark, d, "events").select("event_id", F.coalesce(F.when(e % 3 == 0, k), parts).alias("total_tokens"))


@query("select event_id, user_id, value from (select *, row_number() over (order by event_id) r from events where user_id % 3 = 1 and value > 20) where r <= 200")
def indexed_reader(spark: SparkSession, d: str) -> DataFrame:
    """SRC-9: the first 200 records that meet predicates; these reach the columnar reader, and the limit is the reader's own."""
    return read(spark, d, "events").where("user_id % 3 = 1 and value > 20").select("event_id", "user_id", "value").orderBy("event_id").limit(200)


@query("""with s as (select source, count(*) n, round(avg(n_chars), 1) m from documents group by source), r as (select *, row_number() over (order by n desc, source) p from s) select p as place, '| ' || p || ' | ' || source || ' | ' || n || ' | ' || printf('%.1f', m) || ' |' as line from r""")
def markdown_report(spark: SparkSession, d: str) -> DataFrame:
    """SNK-8: a ranked Markdown table of the sources, one line each."""
    s = read(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 1).alias("m"))
    place = F.row_number().over(Window.orderBy(F.desc("n"), "source"))  # one row per source
    cells = [F.col("place").cast("string"), F.col("source"), F.col("n").cast("string"), F.format_string("%.1f", "m")]
    return s.withColumn("place", place).select("place", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def _modules(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("conv_id")
    block = F.concat(F.lit("<!-- MODULE: m"), F.col("turn"), F.lit(" passage s"), i % 3, F.lit(" -->\n<p>"), F.replace("text", F.lit("\n"), F.lit("<br/>")), F.lit("</p><!-- note -->\n\n\n\nend\n<!-- /MODULE -->"))
    rows = F.array_sort(F.collect_list(F.struct("turn", block.alias("b"))))
    return read(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(rows, lambda r: r["b"]), "\n").alias("raw_text"))


@query(r"""select 'm' || turn as module_id, 'passage' as module_type, 's' || (conv_id % 3) as subject, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(text, chr(10), '<br/>') || chr(10) || chr(10) || chr(10) || chr(10) || 'end', '(?i)<br\s*/?>', chr(10), 'g'), '</?[A-Za-z][^>]*>', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+', ''), '\s+$', '') as body from conversations""")
def module_blocks(spark: SparkSession, d: str) -> DataFrame:
    """SRC-10, SRC-11: modules of marked-up text with clean bodies."""
    return readers.hard_negative_modules(_modules(spark, d))


@query("select 'doc-' || conv_id as doc_id, string_agg(text, chr(10) order by turn) || chr(10) as raw_text from conversations group by conv_id")
def markdown_documents(spark: SparkSession, d: str) -> DataFrame:
    """SRC-1: one document of each Markdown file, named by it."""
    rows = F.array_sort(F.collect_list(F.struct("turn", "text")))
    path = writers.scratch(spark, "markdown")
    docs = read(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(rows, lambda r: r["text"]), "\n").alias("t"))
    writers.text_files(docs.select(F.concat(F.lit("doc-"), "conv_id").alias("name"), "t"), path)
    return readers.markdown(spark, path)


@query("select 's' || (conv_id % 5) as subject, 'c' || conv_id as chapter, role as unit, 't' || turn as problem_type from conversations")
def curriculum_rows(spark: SparkSession, d: str) -> DataFrame:
    """SRC-12: nested curriculum files as rows."""
    turns = read(spark, d, "conversations")
    units = turns.groupBy("conv_id", "role").agg(F.array_sort(F.collect_list(F.concat(F.lit("t"), "turn"))).alias("types"))
    chapters = units.groupBy("conv_id").agg(F.collect_list(F.struct(F.col("role").alias("title"), F.col("types").alias("problem_types"))).alias("units"))
    trees = chapters.groupBy((F.col("conv_id") % 5).alias("s")).agg(F.collect_list(F.struct(F.concat(F.lit("c"), "conv_id").alias("title"), "units")).alias("chapters"))
    path = writers.scratch(spark, "curriculum")
    writers.text_files(trees.select("s", F.to_json(F.struct(F.concat(F.lit("s"), "s").alias("subject"), "chapters"))), path)
    return readers.curriculum(spark, path)


@query("select doc_id, split, n_chars from (select doc_id, n_chars, case when cast(concat('0x', left(md5('42:' || doc_id), 8)) as bigint) / 4294967295.0 < 0.1 then 'dev' else 'train' end as split from documents)")
def dataset_splits(spark: SparkSession, d: str) -> DataFrame:
    """SNK-1: rows by split, as the dataset sink writes them."""
    path = writers.scratch(spark, "dataset")
    writers.dataset(read(spark, d, "documents").select("doc_id", "n_chars"), path)
    return spark.read.parquet(path).select("doc_id", F.col("split").cast("string").alias("split"), "n_chars")


@query("select decision, count(*) as n, min(doc_id) as first from (select doc_id, case when n_chars < 500 then 'DISCARD' when n_chars < 1000 then 'NEEDS_REVISION' else 'PASS' end as decision from documents) group by decision")
def quarantine_move(spark: SparkSession, d: str) -> DataFrame:
    """SNK-7: what lies in each folder of the quarantine."""
    decision = F.when(F.col("n_chars") < 500, "DISCARD").when(F.col("n_chars") < 1000, "NEEDS_REVISION").otherwise("PASS")
    path = writers.scratch(spark, "quarantine")
    writers.quarantine(read(spark, d, "documents").select("doc_id", decision.alias("decision")), path)
    return spark.read.parquet(path).groupBy(F.col("decision").cast("string").alias("decision")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))


@query()
def scaffold_mask(spark: SparkSession, d: str) -> DataFrame:
    """TXT-25: intervals of formulas, tables, metadata, figures, code and images."""
    text = F.concat("text", F.lit(" $x$ `code` <figure id='1'/> ![a](b) $$y\nz$$"))
    return D.per_text(read_texts(spark, d).select("doc_id", text.alias("x")), "x", "masked array<struct<start:int,end:int>>", lambda x: {"masked": S.scaffold_mask(x)})


@query()
def stimulus_integrity(spark: SparkSession, d: str) -> DataFrame:
    """SCR-6: faults of stimuli and a score."""
    made = F.concat(F.lit("<stimulus>"), "text", F.lit("</stimulus><question_label>1.</question_label><section>s</section><stimulus/><stimulus>www.a.b trang 3</stimulus>"))
    turns = read_texts(spark, d, "conversations").select("conv_id", "turn", made.alias("x"))
    return D.per_text(turns, "x", "score double, faults array<string>", S.stimulus_integrity)


@query()
def boundary_ladder(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-13: where a chunk of a conversation overlaps the next one: equal, contained, by suffix, by normalised suffix, by shingles."""
    after = F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    half = F.floor(F.length("text") / 2).cast("int")
    pairs = read(spark, d, "conversations").select("conv_id", "turn", "text", F.concat(F.substr("text", half), F.lit(" "), after).alias("after")).where("after is not null")
    return D.per_text(pairs.select("conv_id", "turn", F.to_json(F.struct("text", "after")).alias("x")), "x", "before_start int, before_end int, after_start int, after_end int, confidence double", D.ladder)


@query()
def typo_injection(spark: SparkSession, d: str) -> DataFrame:
    """GEN-4: words with stripped marks, swapped letters, telex endings or neighbouring keys, chosen by a hash."""
    docs = read_texts(spark, d).select("doc_id", F.to_json(F.struct("doc_id", "text")).alias("x"))
    return D.per_text(docs, "x", "noisy string, changed int", G.typos_of)


@query(r"""select doc_id, flatten(list_transform(w, lambda x: list_transform(range(0, cast(ceil(length(x) / 4) as bigint)), lambda k: case when regexp_full_match(substr(x, 1, 4), '\d+') then case when k = 0 then 'B-number' else 'I-number' end when regexp_matches(x, '^\p{Lu}') then case when k = 0 then 'B-name' else 'I-name' end else 'O' end))) as labels
from (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> '') w from documents)""")
def subword_consistency(spark: SparkSession, d: str) -> DataFrame:
    """WIN-9: continuation pieces take their word's label."""
    return D.per_text(read_texts(spark, d).select("doc_id", F.col("text").alias("x")), "x", "labels array<string>", D.smoothed)


@query()
def atomic_tag_protection(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-39: the tokens of a figure tag take one label."""
    text = F.concat(F.lit("<figure id='a' src='b'/> "), "text", F.lit(" <figure id='c' /> end"))
    return D.per_text(read_texts(spark, d).select("doc_id", text.alias("x")), "x", "labels array<string>", D.protected)
