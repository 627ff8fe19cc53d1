"""Structure of exams by rules: regions of sections, the enumerator that numbers questions in each, the options between two
questions, explanations; and how many of the questions found so an annotated text has."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from difflib import SequenceMatcher

from .spans import Span, lex, scaffold_mask

# Words before a number, those among them that tell a question, first numbers, Roman numerals, headers.
KEYWORD = r"Question|Câu\s*hỏi|Câu|Bài|Part|Phần|Chủ\s*đề|Section|Exercise"
ASKING = ("câu", "câu hỏi", "question", "bài")
STARTS = (1, 101, 201, 301, 401, 501, 601)
ROMAN = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x", "xi", "xii")
SECTION = r"(?:^|\n)\s*(?:#+\s*)?((?:Phần|Part|Chủ\s+đề|Section|Bài\s+thi)\s+(?:[IVXLCDM]+|\d+|[A-Z])[.:\-–\s][^\n]*)(?=\n|$)"
EXPLANATION = r"(?:\A|\n)\s*(?:\*\*|__)?(?:Lời\s+giải|Hướng\s+dẫn\s+giải|Giải\s+thích|Đáp\s+án\s+chi\s+tiết|Solution)(?:\*\*|__)?:?\s*"
ANSWER = r"(?<!\w)(\d{1,4})\s*[.):\-–]\s*(?:\*\*)?([A-D])(?:\*\*)?(?!\w)"

_ENUMERATOR = re.compile(
    rf"(?:^|(?<=[ \t\n]))[ \t]*(?:(?:[-*+]|#{{1,6}})[ \t]+)?(?P<body>(?P<decor>\*\*|__)?(?:(?P<word>{KEYWORD})[ \t]*)?(?P<open>[(\[])?(?P<number>\d{{1,4}}|[a-z]|[ivx]{{1,4}})(?P<close>[)\]])?(?P<stop>[.:)\-/–]?)(?:\*\*|__)?)(?=[ \t\n]|\*\*|$)",
    re.I | re.M,
)
_SECTION, _EXPLANATION, _ANSWER = re.compile(SECTION, re.I | re.M), re.compile(EXPLANATION, re.I), re.compile(ANSWER, re.I)
_HASHES = re.compile(r"[ \t]*(#{1,6})[ \t]+\Z")


@dataclass(frozen=True)
class Mark:
    """A place that may number something: style is (decoration, word, numerals, brackets, terminator)."""

    start: int
    end: int
    style: tuple[str, str, str, str, str]
    value: int


@dataclass
class Exam:
    spans: list[Span]
    questions: int
    options: int
    repeated: int
    confidence: float
    answers: dict[str, str]


def readings(token: str) -> list[tuple[str, int]]:
    """Kinds of numerals that a token can be, with its value in each."""
    case, low = ("upper" if token.isupper() else "lower"), token.lower()
    if token.isdigit():
        return [("arabic", int(token))]
    alpha = [(f"{case}_alpha", ord(low) - 96)] if len(token) == 1 else []
    return alpha + ([(f"{case}_roman", ROMAN.index(low) + 1)] if low in ROMAN else [])


def marks(text: str) -> list[Mark]:
    """Enumerators outside of the mask that have a word, a closing bracket or a terminator, in order."""
    hidden, out = scaffold_mask(text), []
    starts = [a for a, _ in hidden]
    for m in _ENUMERATOR.finditer(text):
        k = bisect_right(starts, m.start("body")) - 1
        if (k >= 0 and m.start("body") < hidden[k][1]) or not (m["word"] or m["close"] or m["stop"]):
            continue
        word = " ".join((m["word"] or "").lower().split())
        for kind, value in readings(m["number"]):
            out.append(Mark(m.start("body"), m.end(), (m["decor"] or "", word, kind, (m["open"] or "") + (m["close"] or ""), m["stop"]), value))
    return out


def _by_style(found: list[Mark]) -> dict[tuple, list[Mark]]:
    out: dict[tuple, list[Mark]] = {}
    for m in found:
        out.setdefault(m.style, []).append(m)
    return out


def numbering(values: list[int], cue: bool) -> float:
    """How well values number questions: they rise by one, leave no gaps, are many, have a cue, start well and never fall back."""
    steps = [b - a for a, b in zip(values, values[1:])]
    rise, full = steps.count(1) / max(1, len(steps)), len(set(values)) / (max(values) - min(values) + 1)
    return 4 * rise + 3 * full + 0.2 * min(len(values), 40) + 5 * cue + 2 * (values[0] in STARTS) - 1.5 * sum(s <= 0 for s in steps)


def question_marks(found: list[Mark]) -> list[Mark]:
    """The marks of the Arabic style that numbers best; ties to the one that comes first."""
    styles = {s: own for s, own in _by_style(found).items() if s[2] == "arabic"}
    score = {s: numbering([m.value for m in own], s[1] in ASKING or s[0] != "") for s, own in styles.items()}
    return styles[max(score, key=score.__getitem__)] if score else []


def option_run(found: list[Mark]) -> list[Mark]:
    """The longest run 1, 2, 3 ... of one style of letters or Arabic numbers; at least two."""
    best: list[Mark] = []
    for style, own in _by_style(found).items():
        run: list[Mark] = []
        if style[2] in ("upper_alpha", "lower_alpha", "arabic"):
            for m in own:
                if m.value == len(run) + 1:
                    run.append(m)
        if len(run) > max(1, len(best)):
            best = run
    return best


def _before_hashes(text: str, start: int, floor: int) -> int:
    """start, or that of the heading marks right before it on its line."""
    line = max(floor, text.rfind("\n", 0, start) + 1)
    m = _HASHES.match(text[line:start])
    return line + m.start(1) if m else start


def parse_exam(text: str) -> Exam:
    """Spans of sections, question labels, stems, option labels and texts and explanations, in order of their starts.

    A text without a question has confidence 0; one where over a quarter of the numbers repeat within their region 0.5; one of over
    ten questions without any option 0.85; others 0.9."""
    found, hidden, out = marks(text), scaffold_mask(text), []
    inside = lambda at: any(a <= at < b for a, b in hidden[max(0, bisect_right(hidden, (at, len(text))) - 1) :][:1])
    places = [m.start for m in found]
    headers = [m.span() for m in _SECTION.finditer(text) if not inside(m.start())]
    edges = sorted({0, len(text), *(a for a, _ in headers)})
    questions = options = repeated = 0

    def add(a: int, b: int, label: str) -> None:
        piece = text[a:b]
        if piece.strip():
            a += len(piece) - len(piece.lstrip())
            out.append(Span(a, a + len(piece.strip()), label))

    for a, b in headers:
        add(a, b, "section")
    for begin, stop in zip(edges, edges[1:]):
        local = found[bisect_left(places, begin) : bisect_left(places, stop)]
        own_places = [m.start for m in local]
        asked = question_marks(local)
        questions += len(asked)
        repeated += len(asked) - len({q.value for q in asked})
        for i, q in enumerate(asked):
            until = _before_hashes(text, asked[i + 1].start, q.end) if i + 1 < len(asked) else stop
            add(_before_hashes(text, q.start, begin), q.end, "question_label")
            run = option_run(local[bisect_left(own_places, q.end) : bisect_left(own_places, until)])
            options += len(run)
            told = _EXPLANATION.search(text[q.end : until])
            told_at = q.end + told.start() if told else until
            stem_end = run[0].start if run else until
            while stem_end > q.end and text.endswith(("**", "__", ":", "."), q.end, stem_end):
                stem_end -= 1
            if told and (not run or told_at > run[-1].end):
                add(told_at, until, "explanation")
            add(q.end, stem_end if run else min(stem_end, told_at), "stem")
            for o, following in zip(run, [*(o.start for o in run[1:]), until]):
                add(o.start, o.end, "option_label")
                add(o.end, min(following, told_at) if told_at > o.end else following, "option_text")
    confidence = 0.0 if not questions else 0.5 if repeated > questions * 0.25 else 0.85 if not options and questions > 10 else 0.9
    return Exam(sorted(out, key=lambda s: s.start), questions, options, repeated, confidence, {m[1]: m[2].upper() for m in _ANSWER.finditer(text)})


def _label(x: str) -> str:
    return re.sub(r"[^\w\s]", "", x).strip().lower()


def _asked(text: str, spans: list[Span]) -> list[tuple[tuple[int, ...], str, str, str]]:
    """(numbers, plain label, stem, label) of each question: its stem is the first before the next label."""
    out: list[list] = []
    for s in sorted(spans, key=lambda s: s.start):
        piece = text[s.start : s.end].strip()
        if s.label == "question_label":
            out.append([tuple(map(int, re.findall(r"\d+", piece))), _label(piece), None, piece])
        elif s.label == "stem" and out and out[-1][2] is None:
            out[-1][2] = " ".join(piece.split()).lower()
    return [(n, label, stem or "", raw) for n, label, stem, raw in out]


def _close(a: str, b: str, least: float) -> bool:
    m = SequenceMatcher(None, a, b)
    return m.real_quick_ratio() >= least and m.quick_ratio() >= least and m.ratio() >= least


def _same_stem(a: str, b: str, part: int, least: float) -> bool:
    """One begins within the other, or the first 50 and 60 characters are alike."""
    head = a[:50]
    return head[:part] in b or b[:part] in a or _close(head, b[:60], least)


def _has(q: tuple, labels: set[str], numbers: dict[tuple[int, ...], list[str]], stems: list[str]) -> bool:
    """The same number with stems that do not contradict (similarity 0.40), the same label, or the same stem (0.75)."""
    own, label, stem, _ = q
    if own and any(len(stem[:50]) < 15 or len(x) < 15 or _same_stem(stem, x, 25, 0.40) for x in numbers.get(own, ())):
        return True
    return (label != "" and label in labels) or (len(stem[:50]) >= 20 and any(_same_stem(stem, x, 35, 0.75) for x in stems))


def coverage(raw: str, tagged: str) -> dict:
    """How many questions of a raw text its tagged form has: detected, annotated, matched, missing labels, score, severity (JN-15, SCR-8).

    One that is tagged as an option or lies in a section of the tagged text counts too.  Nothing to find, or options alone that go on
    with a question of an earlier text, is a score of 100."""
    plain = lex(raw)[0]
    asked = _asked(plain, parse_exam(plain).spans)
    text, spans = lex(tagged)
    known = _asked(text, spans)
    result = {"detected": len(asked), "annotated": len(known), "matched": len(asked), "missing": [], "score": 100.0, "severity": None}
    if not asked or (not known and any(s.label == "option_label" for s in spans)):
        return result
    numbers: dict[tuple[int, ...], list[str]] = {}
    for n, _, stem, _ in known:
        numbers.setdefault(n, []).append(stem)
    labels, stems = {k[1] for k in known}, sorted({k[2] for k in known if len(k[2]) >= 20})
    others = {label: {_label(text[s.start : s.end]) for s in spans if s.label == label} for label in ("option_label", "section")}
    sections = [s for s in others["section"] if len(s) >= 4]
    missing = [q for q in asked if not (_has(q, labels, numbers, stems) or q[1] in others["option_label"] or any(q[1] in s or s in q[1] for s in sections))]
    n, part = len(missing), len(missing) / len(asked)
    severity = None if not n else "critical" if part >= 0.5 and n >= 4 else "major" if part >= 0.2 or n >= 3 else "minor"
    return result | {"matched": len(asked) - n, "missing": [q[3] for q in missing], "score": round(100 * (1 - part), 1), "severity": severity}

