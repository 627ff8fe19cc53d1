"""Sequential span operators: tag lexer, balance, projection, overlap and nesting resolution, serialisation, patching, decoding.

All work on one document at a time in plain Python; the DataFrame wrappers apply them in Arrow batches, so that
parallelism is across documents.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from difflib import SequenceMatcher
from operator import attrgetter, lt

import numpy as np

# Annotation tags by nesting priority (outer ones first), void HTML tags.
PRIORITY = {"section": 0, "stimulus": 1, "question": 2, "explanation": 3, "stem": 4, "question_label": 5, "option_label": 6, "option_text": 7, "figure": 8}
VOID = frozenset(("br", "hr", "img", "input", "meta", "link", "figure", "blank"))

_TAG = re.compile(r"""<(/?)([A-Za-z][A-Za-z0-9_-]*)((?:\s+(?:"[^"]*"|'[^']*'|[^<>"'])*)?)\s*(/?)>""")


@dataclass(frozen=True, init=False)
class Span:
    start: int
    end: int
    label: str
    confidence: float = 1.0
    quality: float = 1.0
    chunk: int = 0
    closed: bool = field(default=True, compare=False)
    raw: str = field(default="", compare=False)  # the tag of a self-closing one

    def __init__(self, start: int, end: int, label: str, confidence: float = 1.0, quality: float = 1.0, chunk: int = 0, closed: bool = True, raw: str = "") -> None:
        # a dictionary takes a fraction of the time that a call for each frozen field does; defaults are those of the class
        own = self.__dict__
        own["start"], own["end"], own["label"] = start, end, label
        if confidence != 1.0:
            own["confidence"] = confidence
        if quality != 1.0:
            own["quality"] = quality
        if chunk:
            own["chunk"] = chunk
        if not closed:
            own["closed"] = closed
        if raw:
            own["raw"] = raw


def lex(tagged: str, labels: Iterable[str] = tuple(PRIORITY)) -> tuple[str, list[Span]]:
    """Text without the known tags, and their spans in it.  Other tags stay text.

    A closing tag ends the nearest open one of its name; what was opened within stays open around it.  Tags that never
    close reach to the end and are marked so; closing tags without an opening one vanish."""
    known = {x.lower() for x in labels}
    out: list[str] = []
    open_tags: list[tuple[str, int]] = []
    spans: list[Span] = []
    at = size = 0
    for m in _TAG.finditer(tagged):
        closing, name = m.group(1, 2)
        name = name.lower()
        if name not in known:
            continue
        a, b = m.span()
        out.append(tagged[at:a])
        size += a - at
        at = b
        if closing:
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] == name:
                    spans.append(Span(open_tags.pop(i)[1], size, name))
                    break
        elif tagged[b - 2] == "/" or name in VOID:
            spans.append(Span(size, size, name, raw=m[0] if tagged[b - 2] == "/" else m[0][:-1].rstrip() + " />"))
        else:
            open_tags.append((name, size))
    out.append(tagged[at:])
    size += len(tagged) - at
    spans += [Span(start, size, name, closed=False) for name, start in open_tags]
    return "".join(out), in_order(spans)


def order_key(s: Span) -> tuple:
    """Total order of spans: by start, longer first, outer labels first."""
    return s.start, -s.end, PRIORITY.get(s.label, 99), s.label


def in_order(spans: list[Span]) -> list[Span]:
    """Spans in their total order; nothing more is compared where each starts behind the one before."""
    starts = [s.start for s in spans]
    return list(spans) if all(map(lt, starts, starts[1:])) else sorted(spans, key=order_key)


def check_balance(tagged: str, void: frozenset[str] = VOID) -> dict[str, int]:
    """Counts of faults by a stack: unclosed, unexpected, mismatched, and tags cut off at the end."""
    faults = {"unclosed": 0, "unexpected": 0, "mismatched": 0, "truncated": 0}
    stack: list[str] = []
    for m in _TAG.finditer(tagged):
        name = m[2].lower()
        if m[4] or name in void:
            continue
        if not m[1]:
            stack.append(name)
        elif stack and stack[-1] == name:
            stack.pop()
        elif name in stack:
            while stack[-1] != name:
                stack.pop()
                faults["mismatched"] += 1
            stack.pop()
        else:
            faults["unexpected"] += 1
    faults["unclosed"] = len(stack)
    faults["truncated"] = int(re.search(r"<[A-Za-z/][^<>]*\Z", tagged) is not None)
    return faults


def rebalance(tagged: str, void: frozenset[str] = VOID) -> str:
    """Close what is open where a closing tag of an outer one comes or the text ends; drop closing tags of nothing."""
    out: list[str] = []
    stack: list[str] = []
    at = 0
    for m in _TAG.finditer(tagged):
        out.append(tagged[at : m.start()])
        at = m.end()
        name = m[2].lower()
        if m[4] or name in void:
            out.append(m[0])
        elif not m[1]:
            stack.append(name)
            out.append(m[0])
        elif name in stack:
            while True:
                top = stack.pop()
                out.append(f"</{top}>")
                if top == name:
                    break
    out.append(tagged[at:])
    return "".join(out) + "".join(f"</{name}>" for name in reversed(stack))


def resolve_overlaps(spans: list[Span]) -> tuple[list[Span], list[Span]]:
    """Best spans first by (confidence, quality, start, chunk); one that overlaps a chosen one is rejected."""
    starts: list[int] = []
    chosen: list[Span] = []  # apart from each other, by start
    rejected: list[Span] = []
    best = sorted(spans, key=attrgetter("start", "chunk", "end", "label"))
    best.sort(key=attrgetter("confidence", "quality"), reverse=True)  # equal ones stay in their order
    for s in best:
        at = bisect_left(starts, s.end) if s.end > s.start else bisect_left(starts, s.start)
        # spans of no length overlap nothing
        i = at - 1
        while i >= 0 and chosen[i].start == chosen[i].end:
            i -= 1
        if s.end > s.start and i >= 0 and chosen[i].end > s.start:
            rejected.append(s)
            continue
        at = bisect_left(starts, s.start)
        starts.insert(at, s.start)
        chosen.insert(at, s)
    return in_order(chosen), rejected


def nest(spans: list[Span]) -> list[Span]:
    """Spans that are nested or apart: one that crosses the end of its encloser is cut there; empty ones go."""
    out: list[Span] = []
    stack: list[Span] = []
    for s in in_order(spans):
        while stack and stack[-1].end <= s.start:
            stack.pop()
        # of the enclosers the innermost ends first
        end = min(s.end, stack[-1].end) if stack else s.end
        if end > s.start or s.start == s.end:
            kept = s if end == s.end and s.closed else Span(s.start, end, s.label, s.confidence, s.quality, s.chunk, raw=s.raw)
            out.append(kept)
            if end > s.start:
                stack.append(kept)
    return out


def serialize(text: str, spans: list[Span]) -> str:
    """The text with the tags of nested spans; taking the tags away gives the text back."""
    out: list[str] = []
    stack: list[Span] = []
    at = 0  # tags come in the order of their places
    for s in nest(spans):
        start, end = s.start, s.end
        while stack and stack[-1].end <= start:
            top = stack.pop()
            out += (text[at : top.end], f"</{top.label}>")
            at = top.end
        out.append(text[at:start])
        at = start
        if start == end:
            out.append(s.raw or f"<{s.label}/>")
        else:
            out.append(f"<{s.label}>")
            stack.append(s)
    while stack:
        top = stack.pop()
        out += (text[at : top.end], f"</{top.label}>")
        at = top.end
    return "".join([*out, text[at:]])


def normalise_map(text: str) -> tuple[str, list[int]]:
    """NFC with runs of white space as one space, and where each kept character stood."""
    out: list[str] = []
    where: list[int] = []
    i, n = 0, len(text)
    while i < n:
        j = i + 1
        if text[i].isspace():
            while j < n and text[j].isspace():
                j += 1
            out.append(" ")
            where.append(i)
        else:
            while j < n and unicodedata.combining(text[j]):
                j += 1
            for c in unicodedata.normalize("NFC", text[i:j]):
                out.append(c)
                where.append(i)
        i = j
    return "".join(out), where


def align(piece: str, source: str, least: float = 0.9) -> tuple[int, int, str, float] | None:
    """Where a piece stands in the source: exactly, else up to white space and normal form, else by similarity."""
    at = source.find(piece) if piece else -1
    if at >= 0:
        return at, at + len(piece), "exact", 1.0
    a, _ = normalise_map(piece.strip())
    b, where = normalise_map(source)
    at = b.find(a) if a else -1
    if at >= 0:
        last = at + len(a) - 1
        return where[at], (where[last + 1] if last + 1 < len(where) else len(source)), "normalised", 0.97
    if not a:
        return None
    block = SequenceMatcher(None, b, a, autojunk=False).find_longest_match()
    lo = max(block.a - block.b, 0)
    part = b[lo : lo + len(a)]
    ratio = SequenceMatcher(None, part, a, autojunk=False).ratio()
    if ratio < least or not part:
        return None
    end = lo + len(part)
    return where[lo], (where[end] if end < len(where) else len(source)), "fuzzy", ratio


def latex_spans(text: str) -> list[tuple[int, int]]:
    """$$...$$ first, then $...$ that do not overlap those, in order."""
    double = re.compile(r"\$\$.+?\$\$", re.S)
    rest = double.sub(lambda m: "\n" * len(m[0]), text)
    return sorted([m.span() for m in double.finditer(text)] + [m.span() for m in re.finditer(r"\$[^$\n]+\$", rest)])


def latex_valid(formula: str) -> bool:
    """Brackets are balanced, and something shows that it is a formula."""
    pairs, stack = {")": "(", "]": "[", "}": "{"}, []
    for c in formula:
        if c in "([{":
            stack.append(c)
        elif c in pairs and (not stack or stack.pop() != pairs[c]):
            return False
    return not stack and bool(re.search(r"[\\^_=+\-*/<>]|\d", formula))


def apply_patches(text: str, reply: str) -> tuple[str, list[str]]:
    """Apply SEARCH/REPLACE blocks of a reply: exact, else by trimmed lines, else by tokens with any white space
    between them (blocks of up to 2500 characters and 300 tokens).  What occurs more than once or never is refused."""
    block = re.compile(r"<{5,9} ?SEARCH\n(.*?)\n?={5,9}\n(.*?)\n?>{5,9} ?REPLACE", re.S)
    refused: list[str] = []
    places: list[tuple[int, int, str]] = []
    for m in block.finditer(reply):
        old, new = m[1], m[2]
        n = text.count(old) if old else 0
        if n == 1:
            at = text.index(old)
            places.append((at, at + len(old), new))
            continue
        if n > 1 or not old:
            refused.append(old)
            continue
        lines = [re.escape(x.strip()) for x in old.splitlines() if x.strip()]
        loose = list(re.finditer(r"[ \t]*" + r"[ \t]*\n\s*".join(lines) + r"[ \t]*", text)) if lines else []
        if not loose and len(old) <= 2500:
            # the tokens with any white space between them
            tokens = re.findall(r"\w+|[^\w\s]", old)
            loose = list(re.finditer(r"\s*".join(map(re.escape, tokens)), text)) if 0 < len(tokens) <= 300 else []
        if len(loose) == 1:
            places.append((loose[0].start(), loose[0].end(), new))
        else:
            refused.append(old)
    last = len(text) + 1
    for a, b, new in sorted(places, reverse=True):
        if b <= last:
            text, last = text[:a] + new + text[b:], a
    return text, refused


def match_spans(gold: list[Span], predicted: list[Span], tolerance: int = 0) -> dict[str, tuple[int, int, int]]:
    """By label, (tp, fp, fn): predictions in order take the first free gold span within the tolerance at both ends."""
    counts: dict[str, list[int]] = {}
    free: dict[tuple[str, int], list[int]] = {}
    for i, g in enumerate(gold):
        free.setdefault((g.label, g.start), []).append(i)
    for p in predicted:
        own = counts.setdefault(p.label, [0, 0, 0])
        near = [(i, k) for k in range(p.start - tolerance, p.start + tolerance + 1) for i in free.get((p.label, k), ()) if abs(gold[i].end - p.end) <= tolerance]
        if near:
            i, k = min(near)
            free[p.label, k].remove(i)
            own[0] += 1
        else:
            own[1] += 1
    for (label, _), left in free.items():
        counts.setdefault(label, [0, 0, 0])[2] += len(left)
    return {k: (v[0], v[1], v[2]) for k, v in counts.items()}


def viterbi(emissions: np.ndarray, tags: list[str], forbidden: float = -1e4) -> list[int]:
    """The best path of BIO tags: an inside tag needs one of its label before it."""
    k = len(tags)
    allowed = np.zeros((k, k))
    for i, a in enumerate(tags):
        for j, b in enumerate(tags):
            if b.startswith("I-") and a[2:] != b[2:]:
                allowed[i, j] = forbidden
    start = np.array([forbidden if t.startswith("I-") else 0.0 for t in tags])
    score, back = emissions[0] + start, np.zeros((len(emissions), k), dtype=int)
    for t in range(1, len(emissions)):
        step = score[:, None] + allowed
        back[t] = step.argmax(axis=0)
        score = step.max(axis=0) + emissions[t]
    path = [int(score.argmax())]
    for t in range(len(emissions) - 1, 0, -1):
        path.append(int(back[t, path[-1]]))
    return path[::-1]


def page_chunks(words: list[int], target: int, most: int, overlap: int = 1, clean: set[int] | None = None) -> list[tuple[list[int], list[int]]]:
    """Greedy chunks of pages: (own pages, pages repeated as context).

    A chunk ends where it has target words and the cut is clean, or, whether clean or not, where it has most words; the
    next one repeats the last pages.  A chunk of repeated pages only does not come."""
    out: list[tuple[list[int], list[int]]] = []
    own: list[int] = []
    context: list[int] = []
    total = 0
    for i, n in enumerate(words):
        own.append(i)
        total += n
        if total >= most or (total >= target and (clean is None or i in clean)):
            out.append((own, context))
            context = own[-overlap:] if overlap else []
            own, total = [], sum(words[p] for p in context)
    if own:
        out.append((own, context))
    return out


ATOMIC = frozenset(("question_label", "stem", "option_label", "option_text"))
_MARKUP = re.compile(r"</?(?:section|stimulus|question|question_label|stem|option_label|option_text|explanation)(?:\s[^<>]*)?/?>|<\|[^<>|]*\|>|</?pages?>|</?page_metadata>", re.I)
_HTML = re.compile(r"""</?(?:figure|table|tr|th|td|tbody|thead|tfoot|caption|colgroup|col|b|i|u|s|strong|em|sub|sup|small|mark|p|br|hr|span|div|a|img|code|pre|ul|ol|li|center|font|del|strike|h[1-6]|blockquote)\b(?:\s+(?:[^<>"']|"[^"]*"|'[^']*')*|\s*/?\s*)>""")


def strip_markup(text: str) -> tuple[str, list[int]]:
    """Text without annotation tags and sentinels, and where each kept character stood; text of nothing else stays."""
    keep, last = [], 0
    for m in _MARKUP.finditer(text):
        keep += range(last, m.start())
        last = m.end()
    keep += range(last, len(text))
    clean = "".join([text[i] for i in keep]) if last else text
    return (clean, keep) if clean.strip() else (text, list(range(len(text))))


def _longest_suffix(a: str, b: str) -> int:
    """The length of the longest end of a that b contains; what contains an end contains all shorter ones."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[len(a) - mid :] in b else (lo, mid - 1)
    return lo


def overlap(before: str, after: str) -> tuple[int, int, int, int] | None:
    """The stretches (start and end in both) that two following texts share, of any confidence."""
    found = boundary(before, after)
    return found and found[:4]


def boundary(before: str, after: str) -> tuple[int, int, int, int, float] | None:
    """The stretches (start and end in both) that two following texts share: exact (confidence 1), up to white space (0.98), or by three
    shingles of three words or more (0.75 and 0.05 for each, 0.95 at most)."""
    if not before.strip() or not after.strip():
        return None
    at = before.find(after)
    if at >= 0:
        return at, at + len(after), 0, len(after), 1.0
    k = _longest_suffix(before, after)
    if k >= 20 and len("".join(before[-k:].split())) >= 15:
        at = after.find(before[-k:])
        return len(before) - k, len(before), at, at + k, 1.0
    (a, of_a), (b, of_b) = normalise_map(before), normalise_map(after)
    k = _longest_suffix(a, b)
    if k and len(a[-k:].strip()) >= 15:
        at = b.find(a[-k:])
        return of_a[len(a) - k], len(before), of_b[at], of_b[at + k - 1] + 1, 0.98
    x, y = list(re.finditer(r"\S+", before)), list(re.finditer(r"\S+", after))
    places: dict[tuple[str, ...], int] = {}
    for i in range(len(y) - 2):
        places.setdefault(tuple(m[0] for m in y[i : i + 3]), i)
    pairs = [(i, places[s]) for i in range(len(x) - 2) if (s := tuple(m[0] for m in x[i : i + 3])) in places]
    if len(pairs) < 3 or pairs[-1][1] < pairs[0][1]:
        return None
    (i, j), (p, q) = pairs[0], pairs[-1]
    return x[i].start(), x[p + 2].end(), y[j].start(), y[q + 2].end(), min(0.95, 0.75 + 0.05 * len(pairs))


def build_source(raws: list[str]) -> tuple[str, list[list[tuple[int, int, int, int]]], int]:
    """The source of overlapping raw chunks, the stretches (start and end in the chunk, and in the source) of each, and how many characters differ where chunks overlap.

    A chunk reuses the places of what it shares with the one before; every other character is appended."""
    source, maps, differ = "", [], 0
    prev, prev_at = "", np.empty(0, dtype=np.int64)
    spread = lambda lo, hi, n: lo + np.minimum(hi - lo - 1, np.arange(n) * (hi - lo) // max(n, 1))
    for n, raw in enumerate(raws):
        clean, kept = strip_markup(raw)
        keep, at = np.array(kept, dtype=np.int64), np.full(len(clean), -1, dtype=np.int64)
        found = overlap(prev, clean) if n else None
        if found:
            a, b, c, d = found
            at[c:d] = prev_at[spread(a, b, d - c)]
            lead = clean[:c]
            again = prev.rfind(lead) if lead.strip() else -1
            if again >= 0:
                at[:c] = prev_at[again : again + c]
            elif len(plain := normalise_map(lead)[0].strip()) >= 15:
                known, where = normalise_map(prev)
                again = known.rfind(plain)
                if again >= 0:
                    at[:c] = prev_at[spread(where[again], where[again + len(plain) - 1] + 1, c)]
        new = np.flatnonzero(at < 0)
        at[new] = len(source) + np.arange(len(new))
        source += clean if len(new) == len(clean) else "".join([clean[k] for k in new.tolist()])
        cuts = [0, *(np.flatnonzero((np.diff(at) != 1) | (np.diff(keep) != 1)) + 1).tolist(), len(clean)] if clean else []
        runs = [(int(keep[k]), int(keep[e - 1]) + 1, int(at[k]), int(at[e - 1]) + 1) for k, e in zip(cuts, cuts[1:])]
        for (k, e), (_, _, p, q) in zip(zip(cuts, cuts[1:]), runs):
            if source[p:q] != clean[k:e]:
                differ += sum(x != y and not (x.isspace() and y.isspace()) for x, y in zip(source[p:q], clean[k:e]))
        maps.append(runs)
        prev, prev_at = clean, at
    return source, maps, differ


def text_map(text: str, raw: str) -> tuple[list[int], str]:
    """For each place of a text, the end included, its place in the raw text, and how: exact, normalised or fuzzy (by words, and by characters between them)."""
    if text == raw:
        return list(range(len(text) + 1)), "exact"
    (a, of_a), (b, of_b) = normalise_map(text), normalise_map(raw)
    where = [-1] * (len(text) + 1)
    if a == b:
        for i, j in zip(of_a, of_b):
            where[i] = j
        kind = "normalised"
    else:
        kind = "fuzzy"
        x, y = (list(re.finditer(r"\w+|[^\w\s]", t)) for t in (text, raw))
        ops = SequenceMatcher(None, [m[0] for m in x], [m[0] for m in y], autojunk=False).get_opcodes()
        for op, i, j, p, q in ops:
            if op == "equal":
                for s, t in zip(x[i:j], y[p:q]):
                    for k in range(len(s[0])):
                        where[s.start() + k] = t.start() + k
                    where[s.end()] = t.end()
            elif op == "replace" and max(x[j - 1].end() - x[i].start(), y[q - 1].end() - y[p].start()) <= 500:
                s, t = x[i].start(), y[p].start()
                for m in SequenceMatcher(None, text[s : x[j - 1].end()], raw[t : y[q - 1].end()], autojunk=False).get_matching_blocks():
                    for k in range(m.size):
                        where[s + m.a + k], where[s + m.a + k + 1] = t + m.b + k, t + m.b + k + 1
    last = 0
    for i, at in enumerate(where):
        last = where[i] = last if at < 0 else max(last, at)
    where[-1] = len(raw)
    return where, kind


def _quality(piece: str, found: str) -> float:
    """How well a found stretch agrees with a piece but for white space: the best of shares of characters and of words."""
    a, b = "".join(piece.split()), "".join(found.split())
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    m = SequenceMatcher(None, a, b, autojunk=len(a) > 2000)
    same = sum(x.size for x in m.get_matching_blocks())
    words, others = set(re.findall(r"\w+", piece)), set(re.findall(r"\w+", found))
    return max(same / len(a), same / len(b), len(words & others) / len(words) if words else 1.0)


def _through(runs: list[tuple[int, int, int, int]], a: int, b: int, raw: str) -> tuple[int, int] | None:
    """A stretch of a chunk in the source; none where it would bridge what stands apart there."""
    if a == b:
        for s, e, p, _ in runs:
            if s <= a <= e:
                return p + a - s, p + a - s
        return (runs[-1][3], runs[-1][3]) if runs else None
    touched = [r for r in runs if r[0] < b and r[1] > a]
    if not touched:
        return None
    for i, (x, y) in enumerate(zip(touched, touched[1:])):
        gap = raw[x[1] : y[0]]
        if y[2] - x[3] == len(_MARKUP.sub("", gap)):
            continue
        if raw[x[1] : b].strip():
            return None
        b, touched = x[1], touched[: i + 1]
        break
    first, last = touched[0], touched[-1]
    return first[2] + max(a - first[0], 0), last[2] + min(b, last[1]) - last[0]


def guard(a: int, b: int, label: str, piece: str, kind: str, source: str, tags: list[tuple[int, int]]) -> tuple[int, int] | None:
    """A projected stretch without white space at its ends, with the piece's closing mark and out of HTML tags; none where a fuzzy one has another length by far."""
    if piece and not piece[-1].isspace():
        while b > a and source[b - 1].isspace():
            b -= 1
    if piece and not piece[0].isspace():
        while a < b and source[a].isspace():
            a += 1
    if piece and piece[-1] in ".!?:" and b < len(source) and source[b] in ".!?:" and label in ("stem", "option_text"):
        b += 1
    bare = piece.strip()
    for end in (False, True):
        i = bisect_left(tags, ((b if end else a),)) - 1
        if i < 0 or tags[i][1] <= (b if end else a):
            continue
        if end:
            b = tags[i][1] if bare.endswith(">") else tags[i][0]
        else:
            a = tags[i][0] if re.match("<[A-Za-z/]", bare) else tags[i][1]
    b = max(a, b)
    n, size = len(piece), b - a
    if kind == "fuzzy" and n and (size > max(n * 3, n + 500) or n > max(size * 3, size + 500)):
        return None
    return a, b


def _score(align: float, closed: bool, at: int, size: int) -> float:
    edge = min(1.0, min(at, size - at) / (size * 0.2 + 1e-5)) if size else 0.5
    return round(0.4 * align + 0.25 * closed + 0.15 + 0.1 * edge, 4)


def reconcile(spans: list[Span], source: str) -> list[Span]:
    """Chosen and nested spans: equal ones are one and surer for it, atomic ones (parts of a question) exclude each other, and containers give way to them.

    A section or stimulus over an atomic span, and an explanation over any chosen one, loses up to three characters at its
    ends; an explanation ends where the next span starts; else the container goes."""
    groups: dict[tuple, list[Span]] = {}
    for s in spans:
        groups.setdefault((s.label, s.start, s.end, s.raw), []).append(s)
    best = []
    for same in groups.values():
        top = max(same, key=lambda s: (s.quality, s.confidence, -s.chunk))
        best.append(replace(top, confidence=min(1.0, top.confidence + 0.05 * (len(same) - 1))))
    rank = lambda s: (-s.confidence, -s.quality, s.start, s.chunk)
    atoms = sorted(resolve_overlaps([s for s in best if s.label in ATOMIC])[0], key=rank)
    chosen = [*atoms, *(s for s in best if s.label not in ATOMIC and s.label not in ("section", "stimulus", "explanation"))]
    for label in ("section", "stimulus", "explanation"):
        own: list[Span] = []
        for s in sorted((s for s in best if s.label == label), key=lambda s: (-s.quality if label == "explanation" else 0.0, *rank(s))):
            if s.start < s.end:
                s = _yield_to(s, [x for x in chosen if x.start < x.end] if label == "explanation" else [x for x in atoms if x.start < x.end], source)
                if s is None or any(max(s.start, x.start) < min(s.end, x.end) for x in own if x.start < x.end):
                    continue
            own.append(s)
        chosen += own
    return nest([s for s in chosen if s.start < s.end or s.raw])


def _yield_to(s: Span, others: list[Span], source: str) -> Span | None:
    for x in others:
        common = min(s.end, x.end) - max(s.start, x.start)
        if common <= 0:
            continue
        end, start = x.start, x.end
        while end > s.start and source[end - 1].isspace():
            end -= 1
        while start < s.end and source[start].isspace():
            start += 1
        if common <= 3 and s.start < x.start and s.end <= x.end and end > s.start:
            s = replace(s, end=end)
        elif common <= 3 and x.start <= s.start and x.end < s.end and start < s.end:
            s = replace(s, start=start)
        elif s.label == "explanation" and s.start < x.start and end > s.start:
            s = replace(s, end=end)
        else:
            return None
    return s


def _sound(source: str, tagged: str, spans: list[Span]) -> bool:
    """Taking the tags away gives the source back, the tags are balanced and all spans lie in the source."""
    if lex(tagged)[0] != lex(source)[0] or any(not 0 <= s.start <= s.end <= len(source) for s in spans):
        return False
    stack: list[str] = []
    for m in _TAG.finditer(tagged):
        name = m[2].lower()
        if name not in PRIORITY or name in VOID or m[0].endswith("/>"):
            continue
        if not m[1]:
            stack.append(name)
        elif not stack or stack.pop() != name:
            return False
    return not stack


def _degrade(source: str, found: list[Span]) -> tuple[str, list[Span], str]:
    spans = reconcile(found, source)
    for level, kept in (("full", spans), ("sound", [s for s in spans if s.quality >= 1 or s.start == s.end])):
        tagged = serialize(source, kept)
        if _sound(source, tagged, kept):
            return tagged, kept, level
    return source, [], "none"


def merge_raw(raws: list[str], chunks: list[str]) -> tuple[str, str, list[Span], str, int]:
    """Overlapping raw chunks and their tagged forms to one document: (source, tagged source, chosen spans, level, characters that differ in overlaps)."""
    source, maps, differ = build_source(raws)
    tags = [m.span() for m in _HTML.finditer(source)]
    found: list[Span] = []
    for number, (raw, chunk, runs) in enumerate(zip(raws, chunks, maps, strict=True)):
        # figures of the raw text are text
        text, spans = lex(chunk, PRIORITY if "<figure" not in raw.lower() else [x for x in PRIORITY if x != "figure"])
        where, kind = text_map(text, raw)
        for s in spans:
            a, b = where[s.start], where[s.end]
            piece = text[s.start : s.end]
            if s.start == s.end:
                if s.raw and (placed := _through(runs, a, a, raw)):
                    found.append(Span(placed[0], placed[0], s.label, 1.0, 1.0, number, raw=s.raw))
                continue
            align = _quality(piece, raw[a:b]) if kind == "fuzzy" else 1.0
            placed = _through(runs, a, b, raw) if align >= 0.9 and a < b and piece.strip() else None
            placed = placed and guard(*placed, s.label, piece, kind, source, tags)
            if placed:
                found.append(Span(*placed, s.label, _score(align, s.closed, a, len(raw)), 1.0 if s.closed else 0.5, number))
    return source, *_degrade(source, found), differ


def merge_chunks(source: str, chunks: list[str]) -> tuple[str, list[Span], str]:
    """Tagged chunks onto their common source: (tagged source, chosen spans, level).

    Spans are lexed, aligned, guarded, reconciled and nested.  Should taking the tags away not give the source back, the
    spans of unclosed tags are dropped (level sound), and then all (none) rather than any character changed."""
    found: list[Span] = []
    tags = [m.span() for m in _HTML.finditer(source)]
    labels = PRIORITY if "<figure" not in source.lower() else [x for x in PRIORITY if x != "figure"]
    for number, chunk in enumerate(chunks):
        text, spans = lex(chunk, labels)
        base = align(text, source)
        where = None
        for s in spans:
            piece = text[s.start : s.end]
            if s.start == s.end:
                if not s.raw or base is None:
                    continue
                if where is None:
                    where = text_map(text, source[base[0] : base[1]])[0]
                at = base[0] + where[s.start]
                found.append(Span(at, at, s.label, 1.0, 1.0, number, raw=s.raw))
                continue
            if not piece.strip():
                continue
            if base and base[2] == "exact":
                a, b, kind, close = base[0] + s.start, base[0] + s.end, "exact", 1.0
            else:
                placed = align(piece.strip(), source)
                if placed is None:
                    continue
                a, b, kind, close = placed
            placed = guard(a, b, s.label, piece.strip(), kind, source, tags)
            if placed:
                found.append(Span(*placed, s.label, _score(close, s.closed, s.start, len(text)), 1.0 if s.closed else 0.5, number))
    return _degrade(source, found)


_QUESTION = re.compile(r"(?m)^[ \t]*(?:(?:Question|Câu|Q)\s*)?(\d{1,3})[.):][ \t]+", re.I)
_OPTION = re.compile(r"(?:(?<=\s)|^)([A-F])[.)]\s+", re.M)


def parse_questions(text: str) -> list[Span]:
    """Spans of numbered questions and lettered options: labels, stems, option labels and texts."""
    out: list[Span] = []
    heads = list(_QUESTION.finditer(text))
    for i, q in enumerate(heads):
        end = heads[i + 1].start() if i + 1 < len(heads) else len(text)
        label_end = q.start() + len(q[0].rstrip())
        label_start = q.start() + len(q[0]) - len(q[0].lstrip())
        out.append(Span(label_start, label_end, "question_label"))
        options, wanted = [], "A"
        for m in _OPTION.finditer(text, q.end(), end):
            if m[1] == wanted:
                options.append(m)
                wanted = chr(ord(wanted) + 1)
        stops = [m.start() for m in options] + [end]

        def add(a: int, b: int, label: str) -> None:
            body = text[a:b]
            a += len(body) - len(body.lstrip())
            if body.strip():
                out.append(Span(a, a + len(body.strip()), label))

        add(q.end(), stops[0], "stem")
        for m, stop in zip(options, stops[1:]):
            add(m.start(), m.start() + 2, "option_label")
            add(m.end(), stop, "option_text")
    return out


def hierarchy(events: list[tuple[str, int]]) -> list[tuple[str, int, str]]:
    """Groups of begin and end events by a stack: (type, number, CLOSED or PARTIAL_CLOSED)."""
    level = {"CHAPTER": 0, "SECTION": 1, "STIM": 2, "Q": 3}
    stack: list[tuple[str, int]] = []
    out: list[tuple[str, int, str]] = []
    for name, number in events:
        kind, _, what = name.rpartition("_")
        if what == "START":
            while stack and level[stack[-1][0]] >= level[kind]:
                out.append((*stack.pop(), "PARTIAL_CLOSED"))
            stack.append((kind, number))
        elif (kind, number) in stack:
            while stack[-1] != (kind, number):
                out.append((*stack.pop(), "PARTIAL_CLOSED"))
            out.append((*stack.pop(), "CLOSED"))
    return out + [(*x, "PARTIAL_CLOSED") for x in reversed(stack)]


def shelf_pack(boxes: list[tuple[int, int]], width: int, height: int) -> list[tuple[int, int, int]]:
    """Canvas, x and y of each box, in rows from left to right; a new canvas where the rows are full."""
    out, canvas, x, y, row = [], 0, 0, 0, 0
    for w, h in boxes:
        if x and x + w > width:
            x, y, row = 0, y + row, 0
        if y and y + h > height:
            canvas, x, y, row = canvas + 1, 0, 0, 0
        out.append((canvas, x, y))
        x, row = x + w, max(row, h)
    return out


def word_windows(lengths: list[int], budget: int, overlap: int) -> list[tuple[int, int]]:
    """Windows of whole words within a budget of pieces; the next one goes back by at most overlap pieces, and always on."""
    out, start, n = [], 0, len(lengths)
    while start < n:
        end, total = start, 0
        while end < n and (end == start or total + lengths[end] <= budget):
            total += lengths[end]
            end += 1
        out.append((start, end))
        if end >= n:
            break
        back, size = end, 0
        while back - 1 > start and size + lengths[back - 1] <= overlap:
            back -= 1
            size += lengths[back]
        start = back
    return out


def repair_json(raw: str) -> str:
    """JSON with stray backslashes doubled and control characters in strings escaped."""
    out, inside, i = [], False, 0
    while i < len(raw):
        c = raw[i]
        if inside and c == "\\":
            following = raw[i + 1 : i + 2]
            if following in set('"\\/bfnrt') or (following == "u" and re.fullmatch(r"[0-9a-fA-F]{4}", raw[i + 2 : i + 6])):
                out.append(c + following)
                i += 2
                continue
            out.append("\\\\")
        elif c == '"':
            inside = not inside
            out.append(c)
        elif inside and ord(c) < 32:
            out.append({"\n": "\\n", "\t": "\\t", "\r": "\\r"}.get(c, f"\\u{ord(c):04x}"))
        else:
            out.append(c)
        i += 1
    return "".join(out)


def smooth_subwords(labels: list[str], continues: list[bool]) -> list[str]:
    """Continuation pieces take the label of their word, as inside tags."""
    out: list[str] = []
    for label, more in zip(labels, continues, strict=True):
        out.append(("I-" + out[-1][2:] if out[-1] != "O" else "O") if more and out else label)
    return out


def first_difference(a: str, b: str, around: int = 30) -> tuple[int, str, str] | None:
    """Where two texts first differ but for white space (in a's characters without it), with what is around."""
    x, y = "".join(a.split()), "".join(b.split())
    if x == y:
        return None
    n = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
    return n, x[max(n - around, 0) : n + around], y[max(n - around, 0) : n + around]


# What candidates of numbering do not count in.
_MASKED = [
    r"\$\$.*?\$\$", r"\$[^\$\n]*\$", r"\\\[.+?\\\]", r"\\\(.+?\\\)", r"<table\b.*?</table>", r"<page_metadata>.*?</page_metadata>", r"\{\s*\"p\":\s*\d+,\s*\"head\":.*?\}(?=\n|$)", r"<\|page\|>Page \d+",
    r"</?pages?>", r"<figure\b[^>]*/>", r"`[^`\n]*`", r"!\[[^\]]*\]\([^)]*\)",
]


def scaffold_mask(text: str) -> list[tuple[int, int]]:
    """Intervals of formulas, tables, metadata, page tags, figures, code and images; touching ones are one (TXT-25)."""
    out: list[list[int]] = []
    for start, end in sorted(m.span() for p in _MASKED for m in re.finditer(p, text, re.DOTALL | re.IGNORECASE)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


_ATTRIBUTES = r"""(?:[^"'>]|"[^"]*"|'[^']*')*"""
_OPENING = re.compile(rf"<(stimulus|section|question_label)\b({_ATTRIBUTES})>?", re.IGNORECASE)
# Page metadata, and watermarks, in a stimulus.
_METADATA = re.compile(r"<page_metadata\b|<pages?\b|\{\s*\"(?:p|page_number|doc_id)\"\s*:", re.IGNORECASE)
_WATERMARK = re.compile(r"https?://\S+|www\.\S+|thuvienhoclieu\.com|trang\s+\d+(?:/\d+)?", re.IGNORECASE)


def _stimulus_fault(inner: str) -> str | None:
    """metadata, empty or junk (under 15 characters but for watermarks); none of the last two where there is a figure or a table."""
    if _METADATA.search(inner):
        return "metadata"
    if re.search(r"<(?:figure|table)\b", inner, re.IGNORECASE):
        return None
    plain = " ".join(re.sub(r"(?s)<!--.*?-->|</?[A-Za-z][^>]*>", " ", inner).split())
    if not plain:
        return "empty"
    return "junk" if len(_WATERMARK.sub("", plain).strip()) < 15 else None


def stimulus_integrity(text: str) -> dict:
    """score and faults: self_closing, metadata, empty or junk stimuli (15 points each), and those that serve a single question before
    the next section or stimulus (10 points).  A stimulus that is never closed is passed over (SCR-6)."""
    opened = [(m.start(), m[1].lower(), m) for m in _OPENING.finditer(text)]
    bounds = [at for at, name, _ in opened if name != "question_label"]
    labels = [at for at, name, _ in opened if name == "question_label"]
    closing = [m.span() for m in re.finditer(r"</stimulus\s*>", text, re.IGNORECASE)]
    faults, at = [], 0
    for start, name, m in opened:
        if name != "stimulus" or start < at or not m[0].endswith(">"):
            continue
        at = m.end()
        if m[2].rstrip().endswith("/"):
            faults.append("self_closing")
            continue
        k = bisect_left(closing, (at, 0))
        if k == len(closing):
            continue
        fault = _stimulus_fault(text[at : closing[k][0]])
        at = closing[k][1]
        b = bisect_left(bounds, at)
        if fault:
            faults.append(fault)
        elif b < len(bounds) and bisect_left(labels, bounds[b]) - bisect_left(labels, at) == 1:
            faults.append("single_question")
    return {"score": max(0.0, 100.0 - sum(10 if f == "single_question" else 15 for f in faults)), "faults": faults}
