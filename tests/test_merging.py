"""Merging of tagged chunks: source builder, projection guards, containers, points and degradation."""

from folioflow.operators import spans as S


def pieces(source, spans):
    return [(source[s.start : s.end], s.label) for s in spans]


def test_source_of_overlapping_chunks():
    text = "one two three four five six seven eight nine ten eleven twelve"
    raws = [text[:40], text[15:]]
    assert S.build_source(raws)[0] == text
    source, tagged, spans, level, differ = S.merge_raw(raws, ["<stem>" + text[:7] + "</stem>" + text[7:40], text[15:57] + "<option_text>" + text[57:] + "</option_text>"])
    assert (source, level, differ) == (text, "full", 0) and S.lex(tagged)[0] == text
    assert pieces(source, spans) == [("one two", "stem"), ("welve", "option_text")]
    spaced = [text[:39], text[15:39].replace(" ", "  ") + text[39:]]
    assert S.build_source(spaced)[0] == text
    assert S.build_source(["abc", "xyz"])[0] == "abcxyz"


def test_overlap_longer_than_any_window():
    text = " ".join(f"w{i}" for i in range(9000))
    assert S.build_source([text[:40000], text[12000:]])[0] == text


def test_points_keep_their_tag():
    tagged, spans, level = S.merge_chunks("see it here", ['see <figure id="a"/>it <stimulus ref="s1" />here'])
    assert level == "full" and tagged == 'see <figure id="a"/>it <stimulus ref="s1" />here' and len(spans) == 2
    raw = 'see <figure id="a"/> it here'
    assert S.merge_raw([raw], ['see <figure id="a"/> <stem>it</stem> <stimulus ref="s1"/>here'])[1] == 'see <figure id="a"/> <stem>it</stem> <stimulus ref="s1"/>here'


def test_containers_give_way_to_atomic_spans():
    text = "a" * 100
    got = S.reconcile([S.Span(0, 50, "stimulus", 0.8), S.Span(40, 80, "stem", 0.9)], text)
    assert [(s.start, s.end, s.label) for s in got] == [(40, 80, "stem")]
    got = S.reconcile([S.Span(0, 42, "stimulus", 0.8), S.Span(40, 80, "stem", 0.9)], text)
    assert [(s.start, s.end, s.label) for s in got] == [(0, 40, "stimulus"), (40, 80, "stem")]
    got = S.reconcile([S.Span(0, 60, "explanation", 0.8), S.Span(40, 80, "stem", 0.9)], text)
    assert [(s.start, s.end, s.label) for s in got] == [(0, 40, "explanation"), (40, 80, "stem")]


def test_guards():
    source = 'x <b class="k">bold</b> end.'
    tags = [m.span() for m in S._HTML.finditer(source)]
    assert S.guard(5, 19, "stem", 'lass="k">bold', "exact", source, tags) == (15, 19)
    assert S.guard(2, 20, "stem", "<b>bold</b>", "exact", source, tags) == (2, 23)
    assert S.guard(0, 2, "stem", "wait.", "exact", "wa..", []) == (0, 3)
    assert S.guard(0, 900, "stem", "short", "fuzzy", "s" * 1000, []) is None


def test_two_steps_of_degradation():
    source = "ok then <stem y>z</stem>"
    tagged, spans, level = S.merge_chunks(source, ["<option_text>ok</option_text> then", "ok"])
    assert level == "full" and pieces(source, spans) == [("ok", "option_text")]
    found = [S.Span(0, 2, "option_text", 0.9, 1.0), S.Span(13, 18, "option_text", 0.9, 0.5)]
    tagged, spans, level = S._degrade(source, found)
    assert level == "sound" and tagged.startswith("<option_text>ok</option_text>")
    assert S._degrade(source, [S.Span(13, 18, "option_text", 0.9, 1.0)]) == (source, [], "none")
