"""Queries of pages, chunks, joins, windows and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.operators import batches as B
from folioflow.operators import pages as P
from folioflow.operators import relational as R
from folioflow.operators import windows as W
from folioflow.registry import query, read, read_texts

WORDS = r"cast(len(case when trim(regexp_replace(text, '\s+', ' ', 'g')) = '' then [] else string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ') end) as bigint)"


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "conversations")


@query("select conv_id, turn, cast(coalesce(sum(length(text) + 2) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0) as bigint) as global_start, cast(coalesce(sum(length(text) + 2) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0) + length(text) as bigint) as global_end from conversations")
def page_offsets(spark: SparkSession, d: str) -> DataFrame:
    """SRC-2: offsets of pages in their document."""
    return P.page_offsets(_turns(spark, d), "conv_id", "turn", "text").select("conv_id", "turn", "global_start", "global_end")


@query("""with n as (select conv_id, turn, case when conv_id % 3 = 0 then turn // 2 else turn * 2 end p from conversations), r as (select *, coalesce(p > lag(p) over w, true) ok, row_number() over w rn from n window w as (partition by conv_id order by turn))
select conv_id, turn, cast(case when bool_and(ok) over (partition by conv_id) then p else rn end as bigint) as page_no from r""")
def page_renumber(spark: SparkSession, d: str) -> DataFrame:
    """SRC-3: page numbers that do not rise are replaced by 1 to n; gaps stay."""
    given = F.when(F.col("conv_id") % 3 == 0, F.floor(F.col("turn") / 2)).otherwise(F.col("turn") * 2)
    return P.renumber(_turns(spark, d).withColumn("p", given), "conv_id", "turn", "p").select("conv_id", "turn", "page_no")


@query("select event_id, case when event_id % 5 = 0 then try_cast(regexp_extract(props, '\"k\":\\s*(\\d+)', 1) as bigint) else cast(json_extract_string(props, '$.k') as bigint) end as k from events")
def page_metadata_recovery(spark: SparkSession, d: str) -> DataFrame:
    """SRC-4: JSON fields, recovered by pattern where the JSON is broken."""
    raw = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("{bad"), "props")).otherwise(F.col("props"))
    return read(spark, d, "events").select("event_id", F.coalesce(F.get_json_object(raw, "$.k").try_cast("long"), F.regexp_extract("props", r'"k":\s*(\d+)', 1).try_cast("long")).alias("k"))


@query("select event_type, cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as total, count(*) as n from events group by event_type")
def props_json_sum(spark: SparkSession, d: str) -> DataFrame:
    """SRC-4, SRC-8: sums over JSON fields."""
    return read(spark, d, "events").groupBy("event_type").agg(F.sum(F.get_json_object("props", "$.k").cast("long")).alias("total"), F.count(F.lit(1)).alias("n"))


@query("""select conv_id, turn from (select conv_id, turn, count(*) over (partition by conv_id) n, row_number() over (partition by conv_id order by turn) r from conversations) where n <= 3 or r = 1 or r in (n // 2 + 1, n // 2 + 2)""")
def page_sampling_first_mid(spark: SparkSession, d: str) -> DataFrame:
    """TXT-13: pages that give a document's context."""
    return P.sample_pages(_turns(spark, d), "conv_id", "turn").select("conv_id", "turn")


@query(f"""with recursive t as (select conv_id, {WORDS} w, row_number() over (partition by conv_id order by turn) r, turn from conversations),
f as (select conv_id, turn, r, w, case when w >= 60 then 0 else w end total, cast(0 as bigint) chunk, w >= 60 as done from t where r = 1 union all
select t.conv_id, t.turn, t.r, t.w, case when f.total + t.w >= 60 then 0 else f.total + t.w end, f.chunk + case when f.done then 1 else 0 end, f.total + t.w >= 60 from f join t on t.conv_id = f.conv_id and t.r = f.r + 1)
select conv_id, chunk, min(turn) as first_turn, max(turn) as last_turn, cast(sum(w) as bigint) as words from f group by conv_id, chunk""")
def chunk_conversations_greedy(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-1 without overlap: a chunk ends once it has 60 words."""
    turns = _turns(spark, d).select("conv_id", "turn", F.size(X.split_words("text")).cast("long").alias("w"))
    docs = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "w"))).alias("p"))
    chunks = docs.withColumn("c", P.greedy_chunks(F.transform("p", lambda p: p["w"]), 60)).select("conv_id", F.explode(F.arrays_zip("p", "c")).alias("x"))
    return chunks.groupBy("conv_id", F.col("x.c").alias("chunk")).agg(F.min("x.p.turn").alias("first_turn"), F.max("x.p.turn").alias("last_turn"), F.sum("x.p.w").alias("words"))


@query("""with recursive t as (select source, doc_id, n_chars // 4 as w, row_number() over (partition by source order by doc_id) r from documents),
f as (select source, doc_id, r, 100 + w total, cast(0 as bigint) batch from t where r = 1 union all
select t.source, t.doc_id, t.r, case when f.total + t.w > 4000 then 100 + t.w else f.total + t.w end, f.batch + case when f.total + t.w > 4000 then 1 else 0 end from f join t on t.source = f.source and t.r = f.r + 1)
select source, batch, min(doc_id) as first, count(*) as docs, cast(max(total) as bigint) as tokens from f group by source, batch""")
def batch_pack_documents(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-4: next-fit batches of 4000 tokens with an overhead of 100 over all documents of a source."""
    found = B.next_fit(read(spark, d, "documents"), "source", "doc_id", F.floor(F.col("n_chars") / 4), 4000, 100)
    return found.select("source", "batch", "first", "docs", "tokens")


@query("""with p as (select conv_id, turn, text, turn // 3 as chunk from conversations), o as (select *, coalesce(sum(length(text) + 2) over (partition by conv_id, chunk order by turn rows between unbounded preceding and 1 preceding), 0) ls from p)
select conv_id, chunk, turn, cast(ls as bigint) as local_start, cast(ls + length(text) as bigint) as local_end, length(string_agg(text, chr(10) || chr(10)) over (partition by conv_id, chunk)) as chunk_chars from o""")
def chunk_plan_offsets(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-3, SEQ-11: where pages stand in their chunk."""
    rows = _turns(spark, d).withColumn("chunk", F.floor(F.col("turn") / 3)).withColumn("key", F.struct("conv_id", "chunk"))
    rows = P.page_offsets(rows, "key", "turn", "text").withColumn("chunk_chars", F.max("global_end").over(Window.partitionBy("conv_id", "chunk")))
    return rows.select("conv_id", "chunk", "turn", F.col("global_start").alias("local_start"), F.col("global_end").alias("local_end"), "chunk_chars")


@query("select conv_id, string_agg('<' || role || '>' || text || '</' || role || '>', chr(10) order by turn) as xml, count(*) as turns from conversations group by conv_id")
def serialize_turns(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-22, SNK-3: tagged text in order."""
    tagged = F.concat(F.lit("<"), "role", F.lit(">"), "text", F.lit("</"), "role", F.lit(">"))
    rows = F.array_sort(F.collect_list(F.struct("turn", tagged.alias("x"))))
    return _turns(spark, d).groupBy("conv_id").agg(F.array_join(F.transform(rows, lambda r: r["x"]), "\n").alias("xml"), F.count(F.lit(1)).alias("turns"))


@query("""with r as (select *, row_number() over (partition by conv_id order by turn) - row_number() over (partition by conv_id, role order by turn) g from conversations) select conv_id, role, min(turn) as first, max(turn) as last, count(*) as n from r group by conv_id, role, g""")
def role_runs(spark: SparkSession, d: str) -> DataFrame:
    """WIN-6, WIN-7: runs of the same role."""
    return R.runs(_turns(spark, d), "conv_id", "turn", "role").select("conv_id", "role", "first", "last", "n")


@query("select a, b, count(*) as n from (select role a, lead(role) over (partition by conv_id order by turn) b from conversations) where b is not null group by a, b")
def role_transition_pairs(spark: SparkSession, d: str) -> DataFrame:
    """AGG-23: transitions between neighbours."""
    follows = F.lead("role").over(Window.partitionBy("conv_id").orderBy("turn"))
    return _turns(spark, d).select(F.col("role").alias("a"), follows.alias("b")).where("b is not null").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


@query("select a.conv_id, a.turn, min(u.turn) as next_user from conversations a left join conversations u on u.conv_id = a.conv_id and u.role = 'user' and u.turn > a.turn where a.role = 'assistant' group by 1, 2")
def next_user_turn_asof(spark: SparkSession, d: str) -> DataFrame:
    """JN-8, JN-9, JN-11: the next row of another kind, by a window instead of a join."""
    after = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(1, Window.unboundedFollowing)
    nearest = F.first(F.when(F.col("role") == "user", F.col("turn")), ignorenulls=True).over(after)
    return _turns(spark, d).withColumn("next_user", nearest).where("role = 'assistant'").select("conv_id", "turn", "next_user")


@query("""with e as (select conv_id, turn, role, max(case when turn % 5 = 0 then turn end) over w z, max(case when role = 'user' and turn % 5 <> 0 then turn end) over w u from conversations window w as (partition by conv_id order by turn rows between unbounded preceding and current row))
select conv_id, turn, case when u > coalesce(z, -1) then u end as active from e""")
def active_fill_with_reset(spark: SparkSession, d: str) -> DataFrame:
    """WIN-4, JN-10, JN-12: the active stimulus, which a section ends."""
    turn = F.col("turn")
    active = R.fill_forward(_turns(spark, d), "conv_id", "turn", F.when(F.col("role") == "user", turn), turn % 5 == 0)
    return _turns(spark, d).select("conv_id", "turn", active.alias("active"))


@query("select conv_id, t as missing from (select conv_id, unnest(range(min(turn), max(turn) + 1)) t from conversations where role = 'user' group by conv_id) x where not exists (select 1 from conversations c where c.role = 'user' and c.conv_id = x.conv_id and c.turn = x.t)")
def missing_turns(spark: SparkSession, d: str) -> DataFrame:
    """AGG-27, SET-2, SEQ-30: numbers of the range that were not seen."""
    seen = _turns(spark, d).where("role = 'user'").groupBy("conv_id").agg(F.min("turn").alias("a"), F.max("turn").alias("b"), F.collect_set("turn").alias("s"))
    return seen.select("conv_id", F.explode(F.array_except(F.sequence("a", "b"), "s")).alias("missing"))


@query("select event_id, coalesce(lag(k) over w + 1 = k, false) or coalesce(k + 1 = lead(k) over w, false) as sequential from (select *, cast(json_extract_string(props, '$.k') as bigint) k from events) window w as (partition by user_id order by ts, event_id)")
def sequential_signal(spark: SparkSession, d: str) -> DataFrame:
    """WIN-3: neighbours whose numbers follow each other."""
    k, w = F.col("k"), Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = read(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    return rows.select("event_id", (F.coalesce(F.lag("k").over(w) + 1 == k, F.lit(False)) | F.coalesce(k + 1 == F.lead("k").over(w), F.lit(False))).alias("sequential"))


@query("""with k as (select user_id, cast(json_extract_string(props, '$.k') as bigint) k, lag(cast(json_extract_string(props, '$.k') as bigint)) over (partition by user_id order by ts, event_id) p from events)
select user_id, count(*) filter (where k > p) as ascending, count(*) filter (where k < p) as resets, count(*) - count(distinct k) as duplicates, round(count(*) filter (where k > p) / greatest(count(*) - 1, 1) * 4 + least(count(*), 40) * 0.2 - 1.5 * count(*) filter (where k < p), 6) as score from k group by user_id""")
def adjacent_ordinals(spark: SparkSession, d: str) -> DataFrame:
    """WIN-1, AGG-19: steps, resets and duplicates of a sequence of numbers, and their score."""
    rows = read(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    rows = rows.withColumn("p", F.lag("k").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    n, up, down = F.count(F.lit(1)), F.count_if(F.col("k") > F.col("p")), F.count_if(F.col("k") < F.col("p"))
    score = up / F.greatest(n - 1, F.lit(1)) * 4 + F.least(n, F.lit(40)) * 0.2 - 1.5 * down
    return rows.groupBy("user_id").agg(up.alias("ascending"), down.alias("resets"), (n - F.countDistinct("k")).alias("duplicates"), F.round(score, 6).alias("score"))


@query("select conv_id, turn, coalesce(lead(turn) over (partition by conv_id order by turn), 1000) as until, count(*) filter (where role = 'user') over (partition by conv_id order by turn rows between 1 following and unbounded following) as users_after from conversations")
def next_boundary_scope(spark: SparkSession, d: str) -> DataFrame:
    """WIN-2, WIN-5: intervals to the next boundary, and what follows."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    after = F.count(F.when(F.col("role") == "user", 1)).over(w.rowsBetween(1, Window.unboundedFollowing))
    return _turns(spark, d).select("conv_id", "turn", F.lead("turn", 1, 1000).over(w).alias("until"), after.alias("users_after"))


TAGS = """(select conv_id, turn, case when role = 'system' then 'O' when role = 'user' then 'B-q' else 'I-' || case when conv_id % 2 = 0 then 'q' else 'a' end end as tag from conversations)"""


def _tags(spark: SparkSession, d: str) -> DataFrame:
    tag = F.when(F.col("role") == "system", "O").when(F.col("role") == "user", "B-q").otherwise(F.concat(F.lit("I-"), F.when(F.col("conv_id") % 2 == 0, "q").otherwise("a")))
    return _turns(spark, d).select("conv_id", "turn", tag.alias("tag"))


@query(f"select conv_id, turn, tag, not (starts_with(tag, 'I-') and coalesce(substring(lag(tag) over (partition by conv_id order by turn), 3), '') <> substring(tag, 3)) as valid from {TAGS}")
def bio_validity(spark: SparkSession, d: str) -> DataFrame:
    """WIN-8: an inside tag needs one of its label before it."""
    before = F.coalesce(F.substring(F.lag("tag").over(Window.partitionBy("conv_id").orderBy("turn")), 3, 50), F.lit(""))
    return _tags(spark, d).select("conv_id", "turn", "tag", (~(F.col("tag").startswith("I-") & (before != F.substring("tag", 3, 50)))).alias("valid"))


@query(f"""with t as (select *, substring(tag, 3) l, lag(tag) over (partition by conv_id order by turn) p from {TAGS}), s as (select *, sum(case when tag = 'O' then 0 when starts_with(tag, 'B-') or p is null or substring(p, 3) <> l then 1 else 0 end) over (partition by conv_id order by turn) seg from t)
select conv_id, cast(seg - 1 as bigint) as segment, l as label, min(turn) as first, max(turn) as last from s where tag <> 'O' group by conv_id, seg, l""")
def bio_segments(spark: SparkSession, d: str) -> DataFrame:
    """WIN-7, WIN-10: entities of tags: a beginning, or an inside tag of another label, starts one."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    label, before = F.substring("tag", 3, 50), F.lag("tag").over(w)
    rows = _tags(spark, d).withColumn("label", label).withColumn("new", F.when(F.col("tag") == "O", 0).when(F.col("tag").startswith("B-") | before.isNull() | (F.substring(before, 3, 50) != label), 1).otherwise(0))
    rows = rows.withColumn("seg", F.sum("new").over(w)).where("tag <> 'O'")
    return rows.groupBy("conv_id", (F.col("seg") - 1).alias("segment"), "label").agg(F.min("turn").alias("first"), F.max("turn").alias("last"))


@query(r"""with t as (select doc_id, i, n, i * 7 as s, i * 7 + 5 as e from (select doc_id, n_chars // 7 n, unnest(range(0, n_chars // 7)) i from documents)), p as (select doc_id, j, j * 50 as a, j * 50 + 30 as b from (select doc_id, unnest(range(0, n_chars // 50 + 1)) j from documents)),
o as (select t.doc_id, t.i, max(p.j) j from t join p on p.doc_id = t.doc_id and greatest(s, a) < least(e, b) group by 1, 2) select doc_id, i, case when lag(j) over (partition by doc_id order by i) = j and lag(i) over (partition by doc_id order by i) = i - 1 then 'I' else 'B' end as tag, j from o""")
def bio_alignment(spark: SparkSession, d: str) -> DataFrame:
    """JN-5, JN-6, WIN-10: tokens get the span of the highest priority that they overlap."""
    docs = read_texts(spark, d).select("doc_id", F.floor(F.col("n_chars") / 7).alias("n"), F.floor(F.col("n_chars") / 50).alias("m"))
    t = docs.where("n > 0").select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i")).withColumn("s", F.col("i") * 7).withColumn("e", F.col("s") + 5)
    p = docs.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m"))).alias("j")).withColumn("a", F.col("j") * 50).withColumn("b", F.col("a") + 30)
    o = R.interval_join(t, p, "doc_id", "s", "e", "a", "b", 512).groupBy("doc_id", "i").agg(F.max("j").alias("j"))
    w = Window.partitionBy("doc_id").orderBy("i")
    return o.select("doc_id", "i", F.when((F.lag("j").over(w) == F.col("j")) & (F.lag("i").over(w) == F.col("i") - 1), "I").otherwise("B").alias("tag"), "j")


@query(r"""with t as (select doc_id, unnest(range(0, n_chars // 7 + 1)) i from documents), p as (select doc_id, unnest(range(0, n_chars // 40 + 1)) j from documents) select t.doc_id, i, min(j) as j from t join p on p.doc_id = t.doc_id and i * 7 + 1 >= j * 40 and i * 7 + 1 < j * 40 + 55 group by 1, 2""")
def anchor_alignment(spark: SparkSession, d: str) -> DataFrame:
    """JN-7: tokens get the first span that holds their first character."""
    docs = read_texts(spark, d).select("doc_id", F.floor(F.col("n_chars") / 7).alias("n"), F.floor(F.col("n_chars") / 40).alias("m"))
    t = docs.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n"))).alias("i")).withColumn("s", F.col("i") * 7 + 1).withColumn("e", F.col("s") + 1)
    p = docs.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m"))).alias("j")).withColumn("a", F.col("j") * 40).withColumn("b", F.col("a") + 55)
    return R.interval_join(t, p, "doc_id", "s", "e", "a", "b", 512).groupBy("doc_id", "i").agg(F.min("j").alias("j"))


SEAM = "(select user_id, event_id, dayofmonth(ts) a, dayofmonth(ts) + event_id % 4 b from events)"


@query(f"select u.user_id, u.p as seam from (select distinct user_id, unnest(range(1, 31)) p from {SEAM}) u where not exists (select 1 from {SEAM} s where s.user_id = u.user_id and s.a <= u.p and u.p < s.b)")
def seam_clean(spark: SparkSession, d: str) -> DataFrame:
    """JN-13: seams that no interval blocks; blocked ones are enumerated instead of compared."""
    s = _intervals(spark, d)
    seams = s.select("user_id").distinct().select("user_id", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(30).cast("long"))).alias("seam"))
    blocked = s.where("b > a").select("user_id", F.explode(F.sequence(F.col("a"), F.col("b") - 1)).alias("seam"))
    return seams.join(blocked, ["user_id", "seam"], "left_anti")


def _intervals(spark: SparkSession, d: str) -> DataFrame:
    day = F.dayofmonth("ts")
    return read(spark, d, "events").select("user_id", "event_id", day.cast("long").alias("a"), (day + F.col("event_id") % 4).alias("b"))


@query(f"select c.user_id, c.p as cut, list_sort(list(s.event_id)) as severed from (select distinct user_id, unnest([8, 16, 24] :: bigint[]) p from {SEAM}) c join {SEAM} s on s.user_id = c.user_id and s.a <= c.p and c.p < s.b group by 1, 2")
def severed_cuts(spark: SparkSession, d: str) -> DataFrame:
    """JN-14: cuts that sever objects, and which."""
    s = _intervals(spark, d)
    hit = s.where("b > a").select("user_id", "event_id", F.explode(F.sequence(F.col("a"), F.col("b") - 1)).alias("cut")).where(F.col("cut").isin(8, 16, 24))
    return hit.groupBy("user_id", "cut").agg(F.array_sort(F.collect_list("event_id")).alias("severed"))


@query("select doc_id, lang from documents where lang is not null and not exists (select 1 from benchmark b where contains(documents.text, b.text))")
def gold_exclusion(spark: SparkSession, d: str) -> DataFrame:
    """FLT-3: documents that hold no benchmark item."""
    return read(spark, d, "documents").where("lang is not null").select("doc_id", "lang").join(_contained(spark, d).select("doc_id").distinct(), "doc_id", "left_anti")


def _contained(spark: SparkSession, d: str) -> DataFrame:
    """Documents and the items that stand in them: they meet on the item's inner words, then the text decides."""
    items = read(spark, d, "benchmark").select("item_id", F.col("text").alias("item"))
    return W.containing(read_texts(spark, d).select("doc_id", "text"), items, "item").where(F.contains("text", "item")).select("doc_id", "item_id", "text", "item")


@query("select doc_id, item_id, instr(d.text, b.text) as place from documents d, benchmark b where contains(d.text, b.text)")
def benchmark_containment(spark: SparkSession, d: str) -> DataFrame:
    """SCR-9: items that stand in documents word for word, and where."""
    return _contained(spark, d).select("doc_id", "item_id", F.expr("instr(text, item)").cast("long").alias("place"))


@query(r"""with g as (select doc_id, unnest(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) g from (select doc_id, string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ') w from documents) where len(w) >= 3),
b as (select item_id, unnest(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) g from (select item_id, string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ') w from benchmark) where len(w) >= 3)
select doc_id, item_id, count(*) as anchors, round(least(0.95, 0.75 + 0.05 * count(*)) :: double, 6) as confidence from g join b using (g) group by 1, 2 having count(*) >= 3""")
def shingle_overlap(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-13: three shared shingles or more align two texts."""
    def shingles(table: str, key: str) -> DataFrame:
        w = F.split(X.collapse_blank("text"), " ")
        gram = F.transform(F.sequence(F.lit(1), F.size("w") - 2), lambda i: F.array_join(F.slice("w", i, F.lit(3)), " "))
        return read_texts(spark, d, table).select(key, w.alias("w")).where(F.size("w") >= 3).select(key, F.explode(F.array_distinct(gram)).alias("g"))

    both = shingles("documents", "doc_id").join(shingles("benchmark", "item_id"), "g").groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("anchors"))
    return both.where("anchors >= 3").select("doc_id", "item_id", "anchors", F.round(F.least(F.lit(0.95), 0.75 + 0.05 * F.col("anchors")), 6).alias("confidence"))


@query("""select event_type, user_id, count(*) calls, cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as tokens, round(sum(value), 4) as duration, round(avg(value), 9) as mean_duration, round(100.0 * count(*) filter (where cast(json_extract_string(props, '$.k') as bigint) % 2 = 0) / count(*), 1) as hit_pct
from events group by grouping sets ((), (event_type), (user_id), (event_type, user_id))""")
def usage_summary_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    """AGG-1: usage in total, by provider, by caller and by both, in one pass."""
    e = read(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    n = F.count(F.lit(1))
    return e.groupingSets([[], ["event_type"], ["user_id"], ["event_type", "user_id"]], "event_type", "user_id").agg(n.alias("calls"), F.sum("k").alias("tokens"), F.round(F.sum("value"), 4).alias("duration"), F.round(F.avg("value"), 9).alias("mean_duration"), F.round(100.0 * F.count_if(F.col("k") % 2 == 0) / n, 1).alias("hit_pct"))


@query("select event_id, count(*) over w as calls, round(sum(value) over w, 4) as tokens, round((0.75 * sum(value) over w + 3.75 * count(*) over w) / 1000000, 12) as cost from events window w as (partition by user_id order by ts range between interval 5 hours preceding and current row)")
def rolling_5h_usage(spark: SparkSession, d: str) -> DataFrame:
    """AGG-2: usage and cost of the five hours before each call, by caller."""
    e = read(spark, d, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    rows = R.trailing(e, "user_id", "us", 5 * 3600 * 1_000_000, total="value")
    return rows.select("event_id", "calls", F.round("total", 4).alias("tokens"), F.round((0.75 * F.col("total") + 3.75 * F.col("calls")) / 1000000, 12).alias("cost"))


@query("select date_trunc('hour', ts) as hour_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
def hourly_tumbling(spark: SparkSession, d: str) -> DataFrame:
    """Batch twin of the hourly usage stream."""
    e = read(spark, d, "events").groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return e.select(F.col("w.start").cast("timestamp_ntz").alias("hour_start"), "event_type", "n", "total")


@query("with s as (select *, unnest([0, 1, 2]) k from events) select epoch(date_trunc('hour', ts) - to_hours(cast(k as integer))) :: bigint as start_s, count(*) as n from s group by 1")
def sliding_window(spark: SparkSession, d: str) -> DataFrame:
    """Windows of three hours every hour."""
    return read(spark, d, "events").groupBy(F.window(F.col("ts").cast("timestamp"), "3 hours", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.unix_timestamp("w.start").alias("start_s"), "n")


@query("""with g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minutes then 0 else 1 end b from events), s as (select *, sum(b) over (partition by user_id order by ts rows unbounded preceding) s from g) select user_id, epoch_us(min(ts)) as start_us, count(*) as n from s group by user_id, s""")
def user_sessions_30m(spark: SparkSession, d: str) -> DataFrame:
    """Sessions that end after 30 minutes without a call."""
    return read(spark, d, "events").groupBy("user_id", F.session_window(F.col("ts").cast("timestamp"), "30 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.unix_micros("w.start").alias("start_us"), "n")


@query("""with u as (select 'event_type' dim, event_type v from events union all select 'user', cast(user_id as varchar) from events union all select 'k', case when event_id % 9 = 0 then 'Unknown / Null' else json_extract_string(props, '$.k') end from events),
c as (select dim, v, count(*) n from u group by 1, 2) select dim, v, n, round(100.0 * n / sum(n) over (partition by dim), 4) as pct from c qualify row_number() over (partition by dim order by n desc, v) <= 15""")
def catalog_distributions(spark: SparkSession, d: str) -> DataFrame:
    """AGG-3, ORD-4: the fifteen most frequent values of each dimension."""
    k = F.when(F.col("event_id") % 9 == 0, "Unknown / Null").otherwise(F.get_json_object("props", "$.k"))
    wide = read(spark, d, "events").select(F.explode(F.create_map(F.lit("event_type"), "event_type", F.lit("user"), F.col("user_id").cast("string"), F.lit("k"), k)).alias("dim", "v"))
    c = wide.groupBy("dim", "v").agg(F.count(F.lit(1)).alias("n"))
    totals = c.groupBy("dim").agg(F.sum("n").alias("t"))  # a row for each dimension
    c = c.join(totals, "dim").withColumn("pct", F.round(100.0 * F.col("n") / F.col("t"), 4)).withColumn("r", F.row_number().over(Window.partitionBy("dim").orderBy(F.desc("n"), "v")))
    return c.where("r <= 15").drop("r", "t")


@query("select source, count(*) n, cast(sum(n_chars) as bigint) as chars, round(100.0 * sum(length(text) - length(replace(text, ' ', ''))) / sum(n_chars), 4) as overhead from documents group by source order by sum(n_chars) desc, source limit 10")
def corpus_report(spark: SparkSession, d: str) -> DataFrame:
    """AGG-11: the ten largest sources."""
    blanks = F.sum(F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))))
    g = read(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"), F.round(100.0 * blanks / F.sum("n_chars"), 4).alias("overhead"))
    return g.orderBy(F.desc("chars"), "source").limit(10)


@query("""with r as (select conv_id, turn, role, case when turn % 4 = 3 then null else length(text) end q from conversations) select conv_id, role, max(q) as best, arg_max(turn, {'q': coalesce(q, -1), 't': -turn}) as chosen, min(turn) as place from r group by conv_id, role""")
def dedup_question_quality(spark: SparkSession, d: str) -> DataFrame:
    """AGG-17, JN-21: one row of each signature: the best, at the place of the first."""
    q = F.when(F.col("turn") % 4 == 3, None).otherwise(F.length("text"))
    rows = _turns(spark, d).withColumn("q", q.cast("long"))
    return rows.groupBy("conv_id", "role").agg(F.max("q").alias("best"), F.max_by("turn", F.struct(F.coalesce("q", F.lit(-1)).alias("q"), (-F.col("turn")).alias("t"))).alias("chosen"), F.min("turn").alias("place"))


@query("""select user_id, event_type, arg_max(event_id, {'v': value, 'e': -event_id}) as best, round(least(1.0, max(value) / 200 + 0.05 * (count(*) - 1)), 6) as confidence from events group by user_id, event_type""")
def span_coalesce(spark: SparkSession, d: str) -> DataFrame:
    """AGG-18: equal spans become their best, whose confidence grows with each that agrees."""
    n, v = F.count(F.lit(1)), F.col("value")
    return read(spark, d, "events").groupBy("user_id", "event_type").agg(F.max_by("event_id", F.struct(v.alias("v"), (-F.col("event_id")).alias("e"))).alias("best"), F.round(F.least(F.lit(1.0), F.max(v) / 200 + 0.05 * (n - 1)), 6).alias("confidence"))


@query("with f as (select conv_id, role, min(turn) i, count(*) n from conversations group by 1, 2) select conv_id, string_agg(role || ':' || n, ',' order by i) as sections from f group by conv_id")
def ordered_regroup(spark: SparkSession, d: str) -> DataFrame:
    """AGG-33: groups in the order in which they first occur."""
    g = _turns(spark, d).groupBy("conv_id", "role").agg(F.min("turn").alias("i"), F.count(F.lit(1)).alias("n"))
    rows = F.array_sort(F.collect_list(F.struct("i", F.concat_ws(":", "role", "n").alias("x"))))
    return g.groupBy("conv_id").agg(F.array_join(F.transform(rows, lambda r: r["x"]), ",").alias("sections"))


@query(r"""select doc_id, string_agg(k || '=' || v, ',' order by k || '=' || v) as keys from (select doc_id, k, last(v order by i) v from (select doc_id, i, ls[i] k, case when i % 2 = 0 then 'A' else 'B' end v from (select doc_id, ls, unnest(range(1, len(ls) + 1)) i from (select doc_id, regexp_extract_all(text, '\d+') ls from documents) where len(ls) > 0)) group by doc_id, k) group by doc_id""")
def answer_key_map(spark: SparkSession, d: str) -> DataFrame:
    """AGG-28: pairs of number and answer; the last one of a number wins."""
    rows = read(spark, d, "documents").select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(r"\d+"), F.lit(0))).alias("i", "k")).withColumn("v", F.when(F.col("i") % 2 == 1, "A").otherwise("B"))
    last = rows.groupBy("doc_id", "k").agg(F.max_by("v", "i").alias("v"))
    return last.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "k", "v"))), ",").alias("keys"))


BASE = "(select user_id, count(*) n, 'old' s from events where event_type <> 'click' group by user_id)"
CHANGE = "(select user_id, count(*) n, 'new' s from events where event_type = 'click' or value > 100 group by user_id)"


@query(f"select coalesce(b.user_id, c.user_id) as user_id, case when c.user_id is not null then c.n else b.n end as n, case when c.user_id is not null then c.s else b.s end as s from {BASE} b full join {CHANGE} c on b.user_id = c.user_id")
def ledger_upsert(spark: SparkSession, d: str) -> DataFrame:
    """SNK-5, SNK-6: changes replace or add rows."""
    e = read(spark, d, "events")
    base = e.where("event_type <> 'click'").groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).withColumn("s", F.lit("old"))
    change = e.where("event_type = 'click' or value > 100").groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).withColumn("s", F.lit("new"))
    return R.upsert(base, change, "user_id", ["n", "s"])


@query(f"select b.user_id, case when c.n > b.n then c.n else b.n end as n, case when c.n is null then 'kept' when c.n > b.n then 'merged' else 'rejected' end as status, coalesce(c.n, b.n) - b.n as delta from {BASE} b left join {CHANGE} c using (user_id)")
def branch_merge(spark: SparkSession, d: str) -> DataFrame:
    """JN-3, JN-26: only known rows change, and only if the branch passes its gate; with the difference."""
    e = read(spark, d, "events")
    base = e.where("event_type <> 'click'").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    change = e.where("event_type = 'click' or value > 100").groupBy("user_id").agg(F.count(F.lit(1)).alias("m"))
    n, m = F.col("n"), F.col("m")
    return base.join(change, "user_id", "left").select("user_id", F.when(m > n, m).otherwise(n).alias("n"), F.when(m.isNull(), "kept").when(m > n, "merged").otherwise("rejected").alias("status"), (F.coalesce(m, n) - n).alias("delta"))


@query("""with l as (select *, row_number() over (partition by user_id, event_type, cast(json_extract_string(props, '$.k') as bigint) order by event_id) r from events where event_id % 2 = 0), r as (select *, row_number() over (partition by user_id, event_type, cast(json_extract_string(props, '$.k') as bigint) order by event_id) r from events where event_id % 2 = 1),
h as (select l.event_id, r.event_id as match, 0 as tier from l join r on l.user_id = r.user_id and l.event_type = r.event_type and l.props = r.props and l.r = r.r),
l2 as (select *, row_number() over (partition by user_id, event_type order by event_id) q from l where event_id not in (select event_id from h)), r2 as (select *, row_number() over (partition by user_id, event_type order by event_id) q from r where event_id not in (select match from h))
select * from h union all select l2.event_id, r2.event_id, 1 from l2 join r2 on l2.user_id = r2.user_id and l2.event_type = r2.event_type and l2.q = r2.q""")
def issue_multiset_match(spark: SparkSession, d: str) -> DataFrame:
    """JN-16, JN-17: issues of two reports match one to one, on the full key first."""
    e = read(spark, d, "events").select("event_id", "user_id", "event_type", "props")
    return R.multiset_cascade(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), [["user_id", "event_type", "props"], ["user_id", "event_type"]], "event_id")


@query("""with p as (select user_id, event_type, arg_max(event_id, {'t': ts, 'e': event_id}) v from events where event_type in ('click', 'view') group by 1, 2) select b.user_id, coalesce(e.v, 0) as edge, a.v as answer from (select distinct user_id from events where event_type = 'purchase') b left join p e on e.user_id = b.user_id and e.event_type = 'click' left join p a on a.user_id = b.user_id and a.event_type = 'view'""")
def graph_patch_latest(spark: SparkSession, d: str) -> DataFrame:
    """JN-23: the last patch of each kind applies; patches of unknown nodes do nothing."""
    e = read(spark, d, "events")
    nodes = e.where("event_type = 'purchase'").select("user_id").distinct()
    patch = e.where(F.col("event_type").isin("click", "view")).groupBy("user_id").agg(*[F.max_by(F.when(F.col("event_type") == t, F.col("event_id")), F.when(F.col("event_type") == t, F.struct("ts", "event_id"))).alias(n) for t, n in (("click", "edge"), ("view", "answer"))])
    return nodes.join(patch, "user_id", "left").select("user_id", F.coalesce("edge", F.lit(0)).alias("edge"), "answer")


@query("""select event_id, case lower(a) when 'yes' then true when 'true' then true when 'y' then true when 'no' then false when 'false' then false end as confirmed from (select event_id, ['Yes', 'no', 'TRUE', 'maybe', 'n/a', 'false', 'y'][cast(event_id % 7 as integer) + 1] a from events)""")
def confirmation_normalise(spark: SparkSession, d: str) -> DataFrame:
    """JN-25: yes and no in words; anything else is null."""
    a = F.lower(F.element_at(F.array(*map(F.lit, ("Yes", "no", "TRUE", "maybe", "n/a", "false", "y"))), (F.col("event_id") % 7 + 1).cast("int")))
    return read(spark, d, "events").select("event_id", F.when(a.isin("yes", "true", "y"), True).when(a.isin("no", "false"), False).alias("confirmed"))


@query("""select event_id from events e where (event_type = 'click' and value > 100) or exists (select 1 from events c where c.user_id = e.user_id and c.event_type = 'view' and c.event_id = e.event_id - 1)""")
def confirmation_gate(spark: SparkSession, d: str) -> DataFrame:
    """JN-18: issues that were confirmed, and critical ones in any case."""
    e = read(spark, d, "events")
    confirmed = e.where("event_type = 'view'").select("user_id", (F.col("event_id") + 1).alias("event_id"), F.lit(True).alias("c"))
    return e.join(confirmed, ["user_id", "event_id"], "left").where((F.col("event_type") == "click") & (F.col("value") > 100) | F.col("c")).select("event_id")


@query("""select d.doc_id, coalesce(l.quality, b.toxic, 7) as value, case when l.doc_id is not null then 'first' when b.doc_id is not null then 'second' else 'none' end as layer from documents d left join (select * from labels where quality = 0) l using (doc_id) left join (select * from labels where toxic = 0) b using (doc_id)""")
def layered_lookup(spark: SparkSession, d: str) -> DataFrame:
    """JN-1, JN-2, JN-4, JN-22, SRC-21: the first layer that has a value."""
    labels = read(spark, d, "labels")
    a, b = labels.where("quality = 0").select("doc_id", F.col("quality").alias("x")), labels.where("toxic = 0").select("doc_id", F.col("toxic").alias("y"))
    rows = read(spark, d, "documents").select("doc_id").join(a, "doc_id", "left").join(b, "doc_id", "left")
    return rows.select("doc_id", F.coalesce("x", "y", F.lit(7)).alias("value"), F.when(F.col("x").isNotNull(), "first").when(F.col("y").isNotNull(), "second").otherwise("none").alias("layer"))


@query("""select conv_id, case when max(turn) filter (where role = 'system') is not null then 'state' when count(*) > 4 then 'round' else 'report' end as source, arg_max(role, turn) as status from conversations group by conv_id""")
def latest_review(spark: SparkSession, d: str) -> DataFrame:
    """JN-27: the latest status, and where it comes from."""
    return _turns(spark, d).groupBy("conv_id").agg(F.when(F.max(F.when(F.col("role") == "system", F.col("turn"))).isNotNull(), "state").when(F.count(F.lit(1)) > 4, "round").otherwise("report").alias("source"), F.max_by("role", "turn").alias("status"))


@query("""with k as (select doc_id, unnest(string_split(text, chr(10))) s from documents), c as (select md5(s) h, case when min(doc_id) % 2 = 0 then 'keep' else 'drop' end v from k group by 1) select doc_id, count(*) filter (where v = 'keep') as kept, count(*) as lines from k join c on md5(s) = h group by doc_id""")
def hash_class_edit(spark: SparkSession, d: str) -> DataFrame:
    """JN-24: what was decided for a text holds wherever it occurs."""
    k = read(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("s")).select("doc_id", F.md5("s").alias("h"))
    c = k.groupBy("h").agg(F.when(F.min("doc_id") % 2 == 0, "keep").otherwise("drop").alias("v"))
    return k.join(c, "h").groupBy("doc_id").agg(F.count_if(F.col("v") == "keep").alias("kept"), F.count(F.lit(1)).alias("lines"))


@query("select doc_id, shard from (select doc_id, (row_number() over (order by doc_id) - 1) % 4 as shard from documents)")
def shard_round_robin(spark: SparkSession, d: str) -> DataFrame:
    """FLT-14: round-robin shards over ranks: counts by range give each range its first rank, so no task sees all rows."""
    docs = read(spark, d, "documents").select("doc_id")
    return R.ranks(docs, "doc_id").select("doc_id", (F.col("rank") % 4).alias("shard"))


@query("select doc_id, n_chars // 64 as bucket, (row_number() over (partition by n_chars // 64 order by doc_id) - 1) // 8 as batch from documents")
def length_bucket_batches(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-10: batches of eight of like length."""
    docs = read(spark, d, "documents").select("doc_id", F.floor(F.col("n_chars") / 64).alias("bucket"))
    return R.ranks(docs, "doc_id", "bucket").select("doc_id", "bucket", F.floor(F.col("rank") / 8).alias("batch"))


@query("select lang, doc_id, r from (select lang, doc_id, row_number() over (partition by lang order by k, source) r from (select lang, source, doc_id, row_number() over (partition by lang, source order by doc_id) k from documents)) where r <= 25")
def stratified_round_robin(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-41: 25 documents of each language, in turn from its sources."""
    k = F.row_number().over(Window.partitionBy("lang", "source").orderBy("doc_id"))
    rows = read(spark, d, "documents").select("lang", "source", "doc_id", k.alias("k")).where("k <= 25")  # no source gives more
    return rows.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("k", "source"))).where("r <= 25").select("lang", "doc_id", F.col("r").cast("long").alias("r"))


@query("""select doc_id, cast(doc_id as varchar) as name from documents union all select doc_id, doc_id || '_aug' from documents where cast('0x' || substring(md5('aug:' || doc_id), 1, 8) as bigint) % 10000 < 2500""")
def aug_pair_sample(spark: SparkSession, d: str) -> DataFrame:
    """GEN-1: a quarter of the documents get an augmented twin."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit("aug:"), "doc_id")), 1, 8), 16, 10).cast("long") % 10000
    names = F.when(h < 2500, F.array(F.lit(""), F.lit("_aug"))).otherwise(F.array(F.lit("")))
    return read(spark, d, "documents").select("doc_id", F.explode(names).alias("tail")).select("doc_id", F.concat(F.col("doc_id").cast("string"), "tail").alias("name"))


@query("select count(*) as real, cast(round(count(*) * 0.4 / 0.6) as bigint) as synthetic from documents")
def synthetic_ratio(spark: SparkSession, d: str) -> DataFrame:
    """GEN-3: how many synthetic documents make 40 %."""
    return read(spark, d, "documents").agg(F.count(F.lit(1)).alias("real")).select("real", F.round(F.col("real") * 0.4 / 0.6).cast("long").alias("synthetic"))


@query("select doc_id, k, case when s >= p then s + 7 else s end as s, case when e > p then e + 7 else e end as e from (select doc_id, k, k * 40 s, k * 40 + 25 e, (n_chars // 3) p from (select doc_id, n_chars, unnest(range(0, n_chars // 40 + 1)) k from documents)) where not (s < p and p < e)")
def span_shift_injection(spark: SparkSession, d: str) -> DataFrame:
    """GEN-14, GEN-9, GEN-13: spans behind an insertion move; none may be split by it."""
    rows = read(spark, d, "documents").select("doc_id", F.floor(F.col("n_chars") / 3).alias("p"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n_chars") / 40))).alias("k")).withColumn("s", F.col("k") * 40).withColumn("e", F.col("k") * 40 + 25)
    s, e, p = F.col("s"), F.col("e"), F.col("p")
    return rows.where(~((s < p) & (p < e))).select("doc_id", "k", F.when(s >= p, s + 7).otherwise(s).alias("s"), F.when(e > p, e + 7).otherwise(e).alias("e"))


@query("""with m as (select p_partkey, split_part(p_type, ' ', 1) s, row_number() over (partition by split_part(p_type, ' ', 1) order by p_partkey) - 1 i, count(*) over (partition by split_part(p_type, ' ', 1)) n from part where p_size < 20),
q as (select doc_id, ['ECONOMY', 'STANDARD', 'PROMO'][cast(doc_id % 3 as integer) + 1] s, cast('0x' || substring(md5(cast(doc_id as varchar)), 1, 8) as bigint) h from documents) select q.doc_id, m.p_partkey as module from q join m on m.s = q.s and m.i = q.h % m.n""")
def module_sampling(spark: SparkSession, d: str) -> DataFrame:
    """GEN-15, GEN-16: one module of the subject and within the length cap, by hash: the hash gives its number, so a document meets one module only."""
    s = F.element_at(F.array(F.lit("ECONOMY"), F.lit("STANDARD"), F.lit("PROMO")), (F.col("doc_id") % 3 + 1).cast("int"))
    q = read(spark, d, "documents").select("doc_id", s.alias("s"), F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("long").alias("h"))
    m = read(spark, d, "part").where("p_size < 20").select("p_partkey", F.split_part("p_type", F.lit(" "), F.lit(1)).alias("s"))
    m = m.withColumn("i", F.row_number().over(Window.partitionBy("s").orderBy("p_partkey")) - 1)
    counts = m.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    return q.join(counts, "s").withColumn("i", F.col("h") % F.col("n")).join(m, ["s", "i"]).select("doc_id", F.col("p_partkey").alias("module"))


@query("""select source, count(*) pages, round(avg(case when n_chars >= 1000 or (n_chars >= 400 and doc_id % 4 <= 2) then 1.0 else 0.0 end), 6) as share, case when avg(case when n_chars >= 1000 or (n_chars >= 400 and doc_id % 4 <= 2) then 1.0 else 0.0 end) >= 0.85 then 'DIGITAL' when avg(case when n_chars >= 1000 or (n_chars >= 400 and doc_id % 4 <= 2) then 1.0 else 0.0 end) <= 0.15 then 'SCANNED' else 'HYBRID' end as kind from documents group by source""")
def digital_scanned(spark: SparkSession, d: str) -> DataFrame:
    """SRC-16: documents by their share of pages with text."""
    digital = ((F.col("n_chars") >= 1000) | ((F.col("n_chars") >= 400) & (F.col("doc_id") % 4 <= 2))).cast("double")
    share = F.avg(digital)
    return read(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("pages"), F.round(share, 6).alias("share"), F.when(share >= 0.85, "DIGITAL").when(share <= 0.15, "SCANNED").otherwise("HYBRID").alias("kind"))


@query("""with b as (select event_id, user_id, value % 100 as y, (value * 7) % 50 as x from events), g as (select *, case when y - lag(y) over (partition by user_id order by y, event_id) <= 12 then 0 else 1 end n from b), r as (select *, sum(n) over (partition by user_id order by y, event_id) row_no from g)
select event_id, cast(row_no as bigint) as row_no, row_number() over (partition by user_id order by row_no, x, event_id) as reading from r""")
def figure_reading_order(spark: SparkSession, d: str) -> DataFrame:
    """SRC-18, SRC-19: boxes in rows by vertical gaps, then from left to right, numbered through."""
    v = F.col("value")
    w = Window.partitionBy("user_id").orderBy("y", "event_id")
    b = read(spark, d, "events").select("event_id", "user_id", (v % 100).alias("y"), ((v * 7) % 50).alias("x"))
    b = b.withColumn("n", F.when(F.col("y") - F.lag("y").over(w) <= 12, 0).otherwise(1)).withColumn("row_no", F.sum("n").over(w))
    return b.select("event_id", "row_no", F.row_number().over(Window.partitionBy("user_id").orderBy("row_no", "x", "event_id")).cast("long").alias("reading"))


@query("select source, count(*) as chunks from documents group by source having count(*) > 1")
def multi_chunk_docs(spark: SparkSession, d: str) -> DataFrame:
    """SRC-6: documents of several chunks."""
    return read(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("chunks")).where("chunks > 1")


@query("select doc_id, source from documents where n_chars between 500 and 15000 and doc_id in (select min(doc_id) from documents group by md5(text)) and length(substring(text, 1, 200)) >= 80")
def admission(spark: SparkSession, d: str) -> DataFrame:
    """FLT-6: size, first page and hash decide on admission."""
    docs = read(spark, d, "documents")
    first = docs.groupBy(F.md5("text").alias("h")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    return docs.where("n_chars between 500 and 15000 and length(substring(text, 1, 200)) >= 80").select("doc_id", "source").join(first, "doc_id", "left_semi")


@query("select event_type as tag, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share from events group by event_type")
def dataset_manifest(spark: SparkSession, d: str) -> DataFrame:
    """SNK-2, AGG-4: counts and shares of the tags of a dataset."""
    c = read(spark, d, "events").groupBy(F.col("event_type").alias("tag")).agg(F.count(F.lit(1)).alias("n"))
    return c.select("tag", "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6).alias("share"))  # one row per tag


@query("select source, lang, avg(n_chars) as mean_chars from documents group by source, lang qualify row_number() over (partition by source order by avg(n_chars) desc, lang) = 1")
def longest_run_pick(spark: SparkSession, d: str) -> DataFrame:
    """ORD-1, ORD-2, ORD-3: the first of a total order with explicit tie keys."""
    g = read(spark, d, "documents").groupBy("source", "lang").agg(F.avg("n_chars").alias("mean_chars"))
    return g.withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("mean_chars"), "lang"))).where("r = 1").drop("r")


@query("""select doc_id, length(text) as chars, sha256(text) = sha256(replace(text, chr(13), '')) as same from documents where doc_id not in (select doc_id from labels where quality = 0)""")
def resume_compatibility(spark: SparkSession, d: str) -> DataFrame:
    """FLT-9: work goes on only where hashes agree."""
    docs = read(spark, d, "documents").join(read(spark, d, "labels").where("quality = 0").select("doc_id"), "doc_id", "left_anti")
    return docs.select("doc_id", F.length("text").cast("long").alias("chars"), (F.sha2("text", 256) == F.sha2(F.replace("text", F.lit("\r"), F.lit("")), 256)).alias("same"))


@query("""with e as (select vec_id, i // 8 as w, i, cast(v as double) v from (select vec_id, generate_subscripts(embedding, 1) - 1 i, unnest(embedding) v from embeddings)), x as (select vec_id, i // 4 as pos, v, 1 + cos((i % 8 - 3.5) / 4) as h from e)
select vec_id, pos, round(sum(v * h) / sum(h), 6) as blended from x group by vec_id, pos""")
def logit_blend(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-38: weighted means of overlapping windows' values."""
    x = read(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v"))
    h = 1 + F.cos((F.col("i") % 8 - 3.5) / 4)
    return x.groupBy("vec_id", F.floor(F.col("i") / 4).alias("pos")).agg(F.round(F.sum(F.col("v").cast("double") * h) / F.sum(h), 6).alias("blended"))


@query("select doc_id, seg, s, e, g + (p - s) as mapped from (select doc_id, k seg, k * 100 s, k * 100 + 80 e, k * 130 + 5 g, unnest([k * 100 + 10, k * 100 + 85]) p from (select doc_id, unnest(range(0, n_chars // 130 + 1)) k from documents)) where p < e")
def piecewise_map(spark: SparkSession, d: str) -> DataFrame:
    """SEQ-15: offsets through ordered segments; gaps between segments map to nothing."""
    seg = read(spark, d, "documents").select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n_chars") / 130))).alias("k"))
    rows = seg.select("doc_id", F.col("k").alias("seg"), (F.col("k") * 100).alias("s"), (F.col("k") * 100 + 80).alias("e"), (F.col("k") * 130 + 5).alias("g"), F.explode(F.array(F.col("k") * 100 + 10, F.col("k") * 100 + 85)).alias("p"))
    return rows.where("p < e").select("doc_id", "seg", "s", "e", (F.col("g") + F.col("p") - F.col("s")).alias("mapped"))


@query("select user_id, event_id, max(event_id % 50) over (partition by user_id order by event_id rows unbounded preceding) as prefix_max from events")
def prefix_max_end(spark: SparkSession, d: str) -> DataFrame:
    """WIN-11: the largest end so far, which bounds the search for overlaps."""
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    return read(spark, d, "events").select("user_id", "event_id", F.max(F.col("event_id") % 50).over(w).alias("prefix_max"))


@query("select doc_id, list_distinct(list_transform(string_split(text, ' '), lambda w: lower(w))).list_sort() as words from documents")
def dedupe_preserving(spark: SparkSession, d: str) -> DataFrame:
    """SET-4: distinct elements (sorted here, for comparison)."""
    return read(spark, d, "documents").select("doc_id", F.array_sort(F.array_distinct(F.transform(F.split("text", " "), lambda w: F.lower(w)))).alias("words"))


@query("select doc_id, lang, 'real' as origin from documents union all select item_id, 'none', 'synthetic' from benchmark")
def union_sources(spark: SparkSession, d: str) -> DataFrame:
    """SET-1: real and synthetic rows together; their order comes from a seeded hash."""
    docs = read(spark, d, "documents")
    made = read(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"), F.lit("none").alias("lang"), F.lit("synthetic").alias("origin"))
    both = docs.select("doc_id", "lang", F.lit("real").alias("origin")).unionByName(made)
    return both.orderBy(F.xxhash64("doc_id", "origin", F.lit(42)))
