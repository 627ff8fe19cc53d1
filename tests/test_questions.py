"""Stimuli, masks, slips, overlaps, ranks and rules of audits against written cases and plain walks."""

import random
import re

import pytest
from pyspark.sql import functions as F

from folioflow.functions import text as X
from folioflow.operators import audit as A
from folioflow.operators import documents as D
from folioflow.operators import questions as Q
from folioflow.operators import relational as R
from folioflow.operators import spans as S
from folioflow.operators import synthetic as G

PASSAGE = "A passage that is long enough to be read."
ASKED = "<question_label>1.</question_label>"


@pytest.mark.parametrize(
    ("text", "score", "faults"),
    [
        ("", 100, []),
        (f"<stimulus>{PASSAGE}</stimulus>{ASKED}{ASKED}<section>x</section>", 100, []),
        (f"<stimulus>{PASSAGE}</stimulus>{ASKED}<section>x</section>", 90, ["single_question"]),
        (f"<stimulus>{PASSAGE}</stimulus>{ASKED}", 100, []),
        ('<stimulus id="a > b" />', 85, ["self_closing"]),
        ("<stimulus> <b> </b> </stimulus>", 85, ["empty"]),
        ("<stimulus><figure id='1'/></stimulus>", 100, []),
        ("<stimulus>www.site.com/x trang 12/40 ab</stimulus>", 85, ["junk"]),
        (f'<stimulus>{{"p": 3}} {PASSAGE}</stimulus>', 85, ["metadata"]),
        (f"<stimulus>{PASSAGE}", 100, []),
        (f"<STIMULUS>{PASSAGE}<stimulus></STIMULUS>{ASKED}<stimulus/>", 75, ["single_question", "self_closing"]),
        ("<stimulus/>" * 9, 0, ["self_closing"] * 9),
    ],
)
def test_stimulus_integrity(text, score, faults):
    assert S.stimulus_integrity(text) == {"score": score, "faults": faults}


def test_mask_covers_the_same_characters_as_a_plain_walk():
    rng, parts = random.Random(4), ["$x$", "$$a\nb$$", "`c`", "<page>", "</pages>", "<figure id='1'/>", "![a](b)", "<table>x</table>", " text ", "\n", "$", "`", r"\(z\)", "<|page|>Page 3"]
    for _ in range(200):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        plain = {i for p in S._MASKED for m in re.finditer(p, text, re.DOTALL | re.IGNORECASE) for i in range(*m.span())}
        found = S.scaffold_mask(text)
        assert {i for a, b in found for i in range(a, b)} == plain
        assert all(a < b for a, b in found) and all(x[1] < y[0] for x, y in zip(found, found[1:]))


def test_typos_are_slips_of_one_kind():
    assert G.typo("thuyền", 0) == "thuyên" and G.typo("ô", 0) == "ô" and G.typo("abc", 1) == "bac" and G.typo("ab", 1) == "ab" and G.typo("an", 2) == "ans"
    assert G.typo("a", 3) == "a" and G.typo("ab", 3) == "qb" and G.typo("éé", 3) == "éé"
    text = " ".join(f"word{i}" for i in range(4000)) + "  end"
    noisy, changed = G.typos(text, 0.1, "7")
    assert G.typos(text, 0.1, "7") == (noisy, changed) != G.typos(text, 0.1, "8") and 250 < changed < 420
    assert len(noisy.split(" ")) == len(text.split(" ")) and G.typos(text, 0, "7") == (text, 0) and G.typos("", 1, "7") == ("", 0)


def test_boundary_ladder():
    tail = "this is the end of the chunk"
    assert S.boundary("abc def", "abc def") == (0, 7, 0, 7, 1.0)
    assert S.boundary("xx abc def yy", "abc def") == (3, 10, 0, 7, 1.0)
    assert S.boundary(f"start {tail}", f"{tail} and more") == (6, 34, 0, 28, 1.0)
    assert S.boundary(f"start {tail}", tail.replace(" ", "\n ") + " and more")[4] == 0.98
    a, b = "one two three four five six seven QQ", "one two three four five six seven ZZ rest"
    assert S.boundary(a, b) == (0, 33, 0, 33, pytest.approx(0.95))
    assert S.boundary("a b c", "d e f") is None and S.boundary("", "x") is None
    assert D.ladder('{"text": "a b", "after": "c d"}') == {"before_start": 3, "before_end": 3, "after_start": 0, "after_end": 0, "confidence": 0.0}


def test_ranks_do_not_need_one_task_for_a_group(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aaaab"), x) for x in rng.sample(range(10_000), 3000)]
    df = spark.createDataFrame(rows, "g string, x long").repartition(7)
    got = {(r.g, r.x): r["rank"] for r in R.ranks(df, "x", "g").collect()}
    assert got == {(g, x): k for g in "ab" for k, x in enumerate(sorted(x for h, x in rows if h == g))}
    assert sorted(r["rank"] for r in R.ranks(df, "x").collect()) == list(range(3000))
    assert R.ranks(df.where("x < 0"), "x", "g").count() == 0


def test_penalties_and_caps(spark):
    rows = [("truncated_output", "MAJOR", 25.0, 60.0), ("missing_stem", "CRITICAL", 35.0, 35.0), ("schema_conformance", "MAJOR", 10.0, 30.0), ("conflict_markers", "CRITICAL", 100.0, 35.0), ("other", "MAJOR", 15.0, 35.0), ("xml_syntax", "INFO", 0.0, 50.0), ("xml_syntax", "ODD", 5.0, 50.0)]
    df = spark.createDataFrame(rows, "c string, s string, p double, k double")
    assert all(r.p == r.x and r.k == r.y for r in df.select("p", "k", A.penalty(F.col("c"), F.col("s")).alias("x"), A.cap(F.col("c")).alias("y")).collect())
    pages = spark.createDataFrame([("<page><PAGE p='1'></page></page></page><think>", 20), ("plain <pager>", 100), ("<pages>" * 5 + "<think>" * 5 + "</page_metadata>" * 2, 0)], "t string, n int")
    assert [r.x for r in pages.select(A.prohibited_score(F.col("t")).alias("x")).collect()] == [100 - 60 - 20, 100, 0]


def test_cooldowns(spark):
    cases = {
        "Resets in 1h2m55s": 3775, "Resets in 11m30s": 690, "resets in 4 hours 45 minutes": 17100, "try again in 5h": 18000, "try again in 280 minutes": 16800, "retry-after: 3600": 3600, "Retry_After 5": 60,
        "wait 2 hours 5 min 3 s": 7503, "45 ms": 0, "retry after 90, took 45 ms": 90, "resets in 0s": 0, "": 0,
    }
    df = spark.createDataFrame(list(cases.items()), "t string, n int")
    assert {r.t: r.x for r in df.select("t", X.cooldown_seconds("t").alias("x")).collect()} == cases
    assert df.select(X.cooldown_seconds(F.lit("none"), 77).alias("x")).first().x == 77


def test_prohibited_tags_go_with_a_log(spark):
    made = "<page_metadata>{}</page_metadata><page>a</page><center>b</center><pager>c</pager><S>d</S>"
    clean, log = X.strip_prohibited("t")
    row = spark.createDataFrame([(made,)], "t string").select(clean.alias("c"), log.alias("l")).first()
    assert row.c == "ab<pager>c</pager>d" and row.l == ["block", "page", "center", "s"]


def test_labels_of_spans(spark):
    rows = [(1, 0, 2, "question_label"), (1, 3, 4, "stem"), (1, 5, 6, "option_label"), (1, 6, 9, "option_text"), (1, 10, 11, "option_label"), (1, 12, 13, "question_label"), (1, 14, 15, "option_text"), (2, 0, 1, "stem")]
    u = Q.under_labels(spark.createDataFrame(rows, "d int, start long, end long, label string"), "d")
    assert sorted(map(tuple, Q.first_of(u, "d", "stem").collect()), key=str) == [(1, 0, 3, 4), (1, 12, None, None)]
    assert sorted(map(tuple, Q.options(u, "d").collect()), key=str) == [(1, 0, 10, None, None), (1, 0, 5, 6, 9)]
