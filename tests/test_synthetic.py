"""Seeded generation: spans keep their texts, results follow from the seed."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.operators import synthetic as G
from folioflow.operators.spans import Span


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab $|\n", max_size=60), st.integers(0, 1000))
def test_jitter_keeps_words_and_spans(text, seed):
    import re

    spans = [Span(m.start(), m.end(), "w") for m in re.finditer(r"\S+", text)]
    new, moved = G.jitter(text, spans, seed)
    assert new.split() == text.split() and new.count("\n") == text.count("\n")
    assert [new[s.start : s.end] for s in moved] == [text[s.start : s.end] for s in spans]
    assert G.jitter(text, spans, seed) == (new, moved)


def test_questions_and_exams():
    text, spans, answer = G.question(3, "Two plus two?", ["3", "4", "5"], 1, 7, "Count.")
    got = [(text[s.start : s.end], s.label) for s in spans]
    assert [g for g in got if g[1] == "option_text"][answer][0] == "4" and ("Two plus two?", "stem") in got and ("Count.", "explanation") in got
    whole, moved = G.exam([(text, spans), (text, spans)])
    assert [whole[s.start : s.end] for s in moved] == [text[s.start : s.end] for s in spans] * 2
    questions = G.group_questions(moved, whole)
    assert len(questions) == 2 and all(len(q["options"]) == 3 and q["stem"] == "Two plus two?" for q in questions)


def test_small_generators():
    orders, right = G.ordering_choices(["a", "b", "c"], 5)
    assert orders[right] == "a - b - c" and len(set(orders)) == 4
    assert G.answer_grid("ABC", 2) == "| 1 | 2 |\n| A | B |\n| 3 |\n| C |"
    assert G.random_windows(100, (10, 20), 0.5, 1)[-1][1] == 100 and G.random_windows(0, (10,), 0.5, 1) == []
    assert G.absorb_heading("x\n## 1.", Span(5, 7, "question_label")) == Span(2, 7, "question_label")
    assert G.expand_references("[CHUNK_1] [CHUNK_2]", {"1": "a"}) == ("a [CHUNK_2]", 1)
    assert G.project_figures('<figure id="a" w="1"/>x<figure id="a"/>', ["a", "b"]) == '<figure id="a"/>x\n<figure id="b"/>'
    assert G.repeated_prefix("x" * 5 + "abcdefghijklmnopqrst", "abcdefghijklmnopqrstz") == 20
    assert G.protect_atomic(["a", "<figure", "id", "/>", "b"], ["O", "B-f", "O", "O", "O"]) == ["O", "B-f", "I-f", "I-f", "O"]
    assert G.decode_figures([[-1, 0, 5, 5, 2.0, -2.0]], 0.5, 4, 4)[0][:4] == (0.0, 0, 4, 4)
    assert [d for _, _, d in G.blueprint("s", 6, 1)] == sorted((d for _, _, d in G.blueprint("s", 6, 1)), key=["easy", "medium", "hard"].index)


@pytest.mark.parametrize("fixed", [True, False])
def test_revision_keeps_the_best(fixed):
    review = lambda t: ("PASS", 90.0) if t == "good" else ("NEEDS_REVISION", float(-len(t)))
    edit = (lambda t: "good") if fixed else (lambda t: t + "!")
    assert G.revise("bad", review, edit) == (("good", "PASS", 90.0) if fixed else ("bad", "NEEDS_REVISION", -3.0))
