"""Questions, stimuli and ordinals over rows of spans: interval joins by running labels instead of comparisons of all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Outer labels first.
ORDER = ("section", "stimulus", "question_label", "stem", "option_label", "option_text", "explanation")
#: First ordinals that a numbering of questions may have.
STARTS = (1, 101, 201, 301, 401, 501, 601)


def priority(label: Column) -> Column:
    """Rank of a label, 99 for unknown ones."""
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, ORDER)), label), F.lit(0)), F.lit(99)).cast("int")


def under_labels(spans: DataFrame, by: str) -> DataFrame:
    """spans (by, start, end, label) with the question label (q, q_end) and the option label (o, o_end) that they stand under.

    q and o are the starts of the last question label, and of the last option label of that question, up to the span."""
    so_far = Window.partitionBy(by).orderBy("start", "end", "label").rowsBetween(Window.unboundedPreceding, 0)
    own = F.last(F.when(F.col("label") == "question_label", F.struct("start", "end")), ignorenulls=True).over(so_far)
    rows = spans.withColumn("_q", own)
    option = F.last(F.when(F.col("label") == "option_label", F.struct("start", "end")), ignorenulls=True).over(so_far)
    rows = rows.withColumn("_o", F.when(option["start"] >= F.col("_q.start"), option))
    return rows.withColumn("q", F.col("_q.start")).withColumn("q_end", F.col("_q.end")).withColumn("o", F.col("_o.start")).withColumn("o_end", F.col("_o.end")).drop("_q", "_o")


def first_of(rows: DataFrame, by: str, label: str) -> DataFrame:
    """by, q, start, end: the first span of a label after each question label and before the next one; null where there is none."""
    hit = F.when((F.col("label") == label) & (F.col("start") >= F.col("q_end")), F.struct("start", "end"))
    return rows.where("q is not null").groupBy(by, "q").agg(F.min(hit).alias("s")).select(by, "q", F.col("s.start").alias("start"), F.col("s.end").alias("end"))


def options(rows: DataFrame, by: str) -> DataFrame:
    """by, q, o, start, end: each option label with the first text between its end and the next label."""
    hit = F.when((F.col("label") == "option_text") & (F.col("start") >= F.col("o_end")), F.struct("start", "end"))
    return rows.where("o is not null").groupBy(by, "q", "o").agg(F.min(hit).alias("s")).select(by, "q", "o", F.col("s.start").alias("start"), F.col("s.end").alias("end"))


def served(objects: DataFrame, by: str, pages: int = 6) -> DataFrame:
    """by, question, stimulus: the stimulus that lists a question, at most so many pages away (the nearest, then the first), else
    the active one if it lists none.  objects: by, place, kind (section, stimulus, question), listed (places).  A section ends a stimulus."""
    lists = objects.where("kind = 'stimulus'").select(by, F.col("place").alias("stimulus"), F.explode("listed").alias("place"))
    near = F.abs(F.col("place") - F.col("stimulus"))
    explicit = lists.where(near <= pages).groupBy(by, "place").agg(F.min_by("stimulus", F.struct(near, "stimulus")).alias("listed_by"))
    so_far = Window.partitionBy(by).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    event = F.when(F.col("kind") == "section", F.struct(F.lit(None).cast("long").alias("p"), F.lit(0).alias("n"))).when(F.col("kind") == "stimulus", F.struct(F.col("place").alias("p"), F.size("listed").alias("n")))
    rows = objects.withColumn("active", F.last(event, ignorenulls=True).over(so_far)).where("kind = 'question'").join(explicit, [by, "place"], "left")
    return rows.select(by, F.col("place").alias("question"), F.coalesce("listed_by", F.when(F.col("active.n") == 0, F.col("active.p"))).alias("stimulus"))


def signature_scores(candidates: DataFrame, by: str, signature: str, order: list[str], ordinal: str, cue: Column) -> DataFrame:
    """by, signature, n, score, first: how well each enumerator signature (cue: whether it has a cue) numbers questions."""
    w = Window.partitionBy(by, signature).orderBy(*order)
    rows = candidates.withColumn("_last", F.lag(ordinal).over(w)).withColumn("_cue", cue)
    o, n = F.col(ordinal), F.count(F.lit(1))
    rising = F.count_if(o == F.col("_last") + 1) / F.greatest(n - 1, F.lit(1))
    density = F.countDistinct(ordinal) / F.greatest(F.max(ordinal) - F.min(ordinal) + 1, F.lit(1))
    start = F.min_by(ordinal, F.struct(*order)).isin(*STARTS)
    score = rising * 4 + density * 3 + F.least(n, F.lit(40)) * 0.2 + F.when(F.bool_or("_cue"), 5).otherwise(0) + F.when(start, 2).otherwise(0) - 1.5 * F.count_if(o <= F.col("_last"))
    return rows.groupBy(by, signature).agg(n.alias("n"), F.round(score, 6).alias("score"), F.min(F.struct(*order)).alias("first"))


def event_order(spans: DataFrame, by: str) -> DataFrame:
    """by, place, at, kind (0 close, 1 self-closing, 2 open), label: the tags of spans (start, end, label, self) in the order in which they are written."""
    p, s, e = priority(F.col("label")), F.col("start").cast("long"), F.col("end").cast("long")
    one = lambda at, kind, extent, rank: F.struct(at.alias("at"), F.lit(kind).alias("kind"), extent.alias("extent"), rank.alias("rank"))
    tags = F.when(F.col("self"), F.array(one(s, 1, F.lit(0).cast("long"), p))).otherwise(F.array(one(s, 2, -e, p), one(e, 0, -s, -p)))
    rows = spans.select(by, "label", F.explode(tags).alias("t")).select(by, "label", "t.*")
    place = F.row_number().over(Window.partitionBy(by).orderBy("at", "kind", "extent", "rank", "label"))
    return rows.select(by, place.alias("place"), "at", "kind", "label")
