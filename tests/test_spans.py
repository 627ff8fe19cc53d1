"""Sequential span operators on written cases, and their invariants on random ones."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from folioflow.operators import spans as S


def test_lex_pairs_nearest_and_marks_unclosed():
    text, spans = S.lex("<section>A <stem>b</stem> <i>c</i></section><stem>d")
    assert text == "A b <i>c</i>d"
    assert [(s.start, s.end, s.label, s.closed) for s in spans] == [(0, 12, "section", True), (2, 3, "stem", True), (12, 13, "stem", False)]


def test_balance_counts_each_fault():
    assert S.check_balance("<a><b></a></c><d") == {"unclosed": 0, "unexpected": 1, "mismatched": 1, "truncated": 1}
    assert S.rebalance("<a><b>x</a></c>y<d>") == "<a><b>x</b></a>y<d></d>"


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab <é\n", max_size=40), st.lists(st.tuples(st.integers(0, 40), st.integers(0, 40), st.sampled_from(sorted(S.PRIORITY))), max_size=6))
def test_serialized_text_is_kept(text, raw):
    spans = [S.Span(min(a, b, len(text)), min(max(a, b), len(text)), label) for a, b, label in raw if a != b]
    nested = S.nest(spans)
    for x in nested:
        for y in nested:
            assert x.end <= y.start or y.end <= x.start or (x.start <= y.start and y.end <= x.end) or (y.start <= x.start and x.end <= y.end)
    assert S.lex(S.serialize(text, spans))[0] == text


def test_overlaps_best_first():
    chosen, rejected = S.resolve_overlaps([S.Span(0, 5, "stem", 0.5), S.Span(4, 9, "stem", 0.9), S.Span(9, 12, "stem", 0.1)])
    assert [(s.start, s.end) for s in chosen] == [(4, 9), (9, 12)] and [(s.start, s.end) for s in rejected] == [(0, 5)]


def test_normalise_map_points_into_the_source():
    text = "a\u0301  b\n\nc"
    plain, where = S.normalise_map(text)
    assert plain == "á b c" and [text[i] for i in where] == ["a", " ", "b", "\n", "c"]


def test_align_ladder():
    assert S.align("b c", "a b c d") == (2, 5, "exact", 1.0)
    assert S.align("b  c", "a b\nc d")[:3] == (2, 5, "normalised")
    assert S.align("the quick brown fox", "xx the quick brwn fox yy")[2] == "fuzzy"
    assert S.align("zzzz", "a b c") is None


def test_merge_chunks_keeps_source_and_agrees():
    source = "1. Two plus two? A. 3 B. 4"
    tagged, spans, level = S.merge_chunks(source, ["<stem>Two plus two?</stem> A. 3", "A. <option_text>3</option_text> B. <option_text>4</option_text>"])
    assert level == "full" and S.lex(tagged)[0] == source
    assert [(source[s.start : s.end], s.label) for s in spans] == [("Two plus two?", "stem"), ("3", "option_text"), ("4", "option_text")]


def test_patches_refuse_what_is_ambiguous():
    block = "<<<<<<< SEARCH\n{}\n=======\n{}\n>>>>>>> REPLACE\n"
    assert S.apply_patches("one two", block.format("two", "2")) == ("one 2", [])
    assert S.apply_patches("a a", block.format("a", "b")) == ("a a", ["a"])
    assert S.apply_patches("  x\n   y", block.format("x\ny", "z")) == ("z", [])


def test_viterbi_equals_brute_force():
    import itertools

    tags, rng = ["O", "B-a", "I-a", "B-b", "I-b"], np.random.default_rng(1)
    for _ in range(10):
        e = rng.normal(size=(4, 5))

        def valid(p):
            return all(not tags[t].startswith("I-") or (i and tags[p[i - 1]][2:] == tags[t][2:]) for i, t in enumerate(p))

        best = max((p for p in itertools.product(range(5), repeat=4) if valid(p)), key=lambda p: sum(e[i, t] for i, t in enumerate(p)))
        assert S.viterbi(e, tags) == list(best)


def test_page_chunks_repeat_the_last_page():
    assert S.page_chunks([10, 10, 10], 20, 30) == [([0, 1], []), ([2], [1])]
    assert S.page_chunks([10, 10], 20, 30) == [([0, 1], [])]
    assert S.page_chunks([10, 10, 10, 10], 20, 40, 0, clean={2}) == [([0, 1, 2], []), ([3], [])]


def test_word_windows_cover_all():
    rng = random.Random(3)
    for _ in range(30):
        lengths = [rng.randint(1, 20) for _ in range(rng.randint(0, 40))]
        found = S.word_windows(lengths, 16, 5)
        assert all(sum(lengths[a:b]) <= 16 or b - a == 1 for a, b in found)
        assert {i for a, b in found for i in range(a, b)} == set(range(len(lengths)))


def test_parse_questions():
    text = "Question 1. Two?\nA. 3\nB. 4\n2) Next\nA. x\nB. y"
    got = [(text[s.start : s.end], s.label) for s in S.parse_questions(text)]
    assert got[:6] == [("Question 1.", "question_label"), ("Two?", "stem"), ("A.", "option_label"), ("3", "option_text"), ("B.", "option_label"), ("4", "option_text")]
    assert ("2)", "question_label") in got and ("y", "option_text") in got


def test_hierarchy_and_shelves_and_json():
    assert S.hierarchy([("SECTION_START", 1), ("Q_START", 1), ("Q_END", 1), ("Q_START", 2), ("SECTION_START", 2)]) == [("Q", 1, "CLOSED"), ("Q", 2, "PARTIAL_CLOSED"), ("SECTION", 1, "PARTIAL_CLOSED"), ("SECTION", 2, "PARTIAL_CLOSED")]
    assert S.shelf_pack([(60, 10), (60, 20), (50, 85)], 100, 100) == [(0, 0, 0), (0, 0, 10), (1, 0, 0)]
    assert S.repair_json('{"a": "\\alpha\n"}') == '{"a": "\\\\alpha\\n"}'
    assert S.latex_spans("$$a$$ $b$ $") == [(0, 5), (6, 9)] and S.latex_valid("x^2") and not S.latex_valid("(x")
    assert S.match_spans([S.Span(0, 3, "a")], [S.Span(1, 3, "a"), S.Span(0, 3, "a")], 1) == {"a": (1, 1, 0)}
    assert S.smooth_subwords(["B-a", "O", "O"], [False, True, False]) == ["B-a", "I-a", "O"]
    assert S.first_difference("a b", "ab") is None and S.first_difference("abc", "abd")[0] == 2
