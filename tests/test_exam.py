"""The rule parser, coverage of questions and the choice of distant rows against written cases and plain loops."""

import numpy as np
import pytest

from folioflow.operators import exam as E
from folioflow.operators.curate import farthest_first_quotas

TEXT = """PHẦN I. Choice
Câu 1. Take $1. x$ from
1) one thing
2) another thing
A. one
B. two
C. three
Lời giải: A. is right
## Câu 2. Then
a) yes b) no
PHẦN II. Essay
Câu 1. Explain it at length.
Solution: none
"""


def spans(text):
    return [(text[s.start : s.end], s.label) for s in E.parse_exam(text).spans]


def test_exam_has_regions_options_and_explanations():
    assert spans(TEXT) == [
        ("PHẦN I. Choice", "section"),
        ("Câu 1.", "question_label"),
        ("Take $1. x$ from\n1) one thing\n2) another thing", "stem"),
        ("A.", "option_label"),
        ("one", "option_text"),
        ("B.", "option_label"),
        ("two", "option_text"),
        ("C.", "option_label"),
        ("three", "option_text"),
        ("Lời giải: A. is right", "explanation"),
        ("## Câu 2.", "question_label"),
        ("Then", "stem"),
        ("a)", "option_label"),
        ("yes", "option_text"),
        ("b)", "option_label"),
        ("no", "option_text"),
        ("PHẦN II. Essay", "section"),
        ("Câu 1.", "question_label"),
        ("Explain it at length.", "stem"),
        ("Solution: none", "explanation"),
    ]
    e = E.parse_exam(TEXT)
    assert (e.questions, e.options, e.repeated, e.confidence) == (3, 5, 0, 0.9)


@pytest.mark.parametrize(("text", "questions", "confidence"), [("", 0, 0.0), ("no numbers at all", 0, 0.0), ("1. a\n1. b\n1. c", 3, 0.5), ("\n".join(f"{i}. x" for i in range(1, 13)), 12, 0.85)])
def test_confidence(text, questions, confidence):
    e = E.parse_exam(text)
    assert (e.questions, e.confidence) == (questions, confidence)


def test_numbering_prefers_rising_numbers_with_a_cue():
    assert E.numbering([1, 2, 3], True) == pytest.approx(4 + 3 + 0.6 + 5 + 2)
    assert E.numbering([2, 2, 9], False) == pytest.approx(0 + 3 * 2 / 8 + 0.6 - 1.5)
    assert E.readings("i") == [("lower_alpha", 9), ("lower_roman", 1)] and E.readings("IV") == [("upper_roman", 4)] and E.readings("xiv") == []


def tag(label, stem):
    return f"<question_label>{label}</question_label><stem>{stem}</stem>"


STEM = "which of these long sentences is the right one"


@pytest.mark.parametrize(
    ("tagged", "matched", "severity"),
    [
        (tag("Câu 03.", STEM), 1, None),
        (tag("Câu 3.", "utterly 8762 foreign 5 12345"), 1, None),  # the same label
        (tag("3)", "0987654321 0987654321"), 0, "major"),  # the same number, but stems that contradict
        (tag("9.", STEM.upper()), 1, None),
        (tag("9.", STEM.replace("long", "lonk").replace("which", "whiche")), 1, None),
        (tag("9.", "short"), 0, "major"),
        (tag("9.", "short") + "<option_label>Câu 3</option_label>", 1, None),
        (tag("9.", "short") + "<section>Phần câu 3 và</section>", 1, None),
        ("<option_label>A.</option_label>", 1, None),  # goes on with an earlier question
        ("", 0, "major"),
    ],
)
def test_coverage(tagged, matched, severity):
    got = E.coverage(f"Câu 3. {STEM}", tagged)
    assert (got["detected"], got["matched"], got["severity"], got["score"]) == (1, matched, severity, 100.0 * matched)


def test_nothing_to_cover_is_full():
    assert E.coverage("", tag("1.", "x"))["score"] == 100.0 == E.coverage("plain words", "")["score"]


def plain_choice(rows, quotas, cap):
    x = np.array([r[3] for r in rows], dtype=float)
    x = (x - x.mean(axis=0)) / (x.std(axis=0) + 1e-6)
    start = [i for i, r in enumerate(rows) if r[1] == next(iter(quotas)) and r[2] <= cap] or list(range(len(rows)))
    chosen = [min(start, key=lambda i: np.linalg.norm(x[i] - x[start].mean(axis=0)))]
    filled = dict.fromkeys(quotas, 0)
    while True:
        if rows[chosen[-1]][1] in filled:
            filled[rows[chosen[-1]][1]] += rows[chosen[-1]][2]
        free = [i for i, r in enumerate(rows) if i not in chosen and r[1] in quotas and filled[r[1]] < quotas[r[1]]]
        free = [i for i in free if rows[i][2] <= cap] or free
        if not free:
            return [rows[i][0] for i in chosen]
        chosen.append(max(free, key=lambda i: np.linalg.norm(x[chosen] - x[i], axis=1).min()))


@pytest.mark.parametrize(("pool", "cap", "quotas"), [(3, 500, {"a": 4000, "b": 2500}), (200, 500, {"a": 4000, "b": 2500}), (5, 150, {"b": 3000, "c": 10**9}), (4, 500, {"z": 100, "a": 900})])
def test_distant_rows_fill_quotas(spark, pool, cap, quotas):
    rng = np.random.default_rng(pool)
    rows = [(i, "abc"[i % 3], int(rng.integers(50, 700)), rng.normal(size=4).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, tier string, n long, v array<double>")
    got = farthest_first_quotas(df, "id", "tier", "n", "v", quotas, cap, pool=pool).orderBy("place").collect()
    assert [r["id"] for r in got] == plain_choice(rows, quotas, cap)


def test_distant_rows_of_empty_and_repeated_tables(spark):
    schema = "id long, tier string, n long, v array<double>"
    assert farthest_first_quotas(spark.createDataFrame([], schema), "id", "tier", "n", "v", {"a": 5}, 9).count() == 0
    same = spark.createDataFrame([(1, "a", 2, [1.0, 2.0])] * 3 + [(None, "a", 2, [1.0, 2.0]), (2, "a", 2, None)], schema)
    assert [r["id"] for r in farthest_first_quotas(same, "id", "tier", "n", "v", {"a": 50}, 9).collect()] == [1]
