"""Seeded augmentation and synthetic questions: every result follows from its seed, and spans move with their text."""

from __future__ import annotations

import itertools
import json
import random
import re
import unicodedata
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable

import numpy as np

from .spans import Span

# Kinds of a style profile, and levels by cognitive verb.
STYLES = {
    "paper": ("white", "cream", "grey"), "noise": ("none", "light", "heavy"), "columns": ("one", "two"), "font": ("serif", "sans"), "size": ("10", "11", "12"), "margin": ("narrow", "wide"),
    "numbers": ("1.", "1)", "Question 1:"), "letters": ("A.", "A)", "a)"), "header": ("yes", "no"), "footer": ("yes", "no"),
}
LEVELS = {"recall": "easy", "understand": "easy", "apply": "medium", "analyse": "hard", "create": "hard"}
LABELS = ("Question {n}.", "Question {n}:", "{n}.", "{n})", "Q{n}.")
NEIGHBOURS = {"a": "sq", "e": "wr", "i": "uo", "o": "ip", "n": "bm", "s": "ad", "t": "ry"}


#: 31 to the power of 4095 ... 1, 0, modulo 2^32.
_POWERS = np.concatenate([np.cumprod(np.full(4095, 31, dtype=np.uint32), dtype=np.uint32)[::-1], np.ones(1, dtype=np.uint32)])


def stable_seed(text: str) -> int:
    """Polynomial hash of base 31 over code points, modulo 2^32, which the products and sums of 32 bits take by themselves."""
    codes, out = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4"), 0
    for at in range(0, len(codes), len(_POWERS)):
        piece = codes[at : at + len(_POWERS)]
        own = int((piece * _POWERS[len(_POWERS) - len(piece) :]).sum(dtype=np.uint32))
        out = (out * pow(31, len(piece), 1 << 32) + own) % (1 << 32)
    return out


def rewrite(text: str, spans: list[Span], pattern: str, change: Callable[[re.Match], str], keep: str | None = None) -> tuple[str, list[Span]]:
    """Replace the matches of a pattern outside of what keep matches, and move the spans along.

    A span's end within a replaced part goes to the part's new end, its start to the new start."""
    protected = [m.span() for m in re.finditer(keep, text, re.M)] if keep else []
    begins = [a for a, _ in protected]
    out: list[str] = []
    at = shift = 0
    starts: list[int] = []  # of the replaced parts, their ends, and by how much what follows each moves
    ends: list[int] = []
    shifts = [0]
    for m in re.finditer(pattern, text):
        a, b = m.span()
        if protected:
            i = bisect_right(begins, a)
            if (i and protected[i - 1][1] > a) or (i < len(begins) and begins[i] < b):
                continue
        new = change(m)
        if new != m[0]:
            out += (text[at:a], new)
            at = b
            shift += len(new) - (b - a)
        starts.append(a)
        ends.append(b)
        shifts.append(shift)
    out.append(text[at:])
    if not spans:
        return "".join(out), []

    first, last, moved_by = np.array([*starts, len(text) + 1]), np.array([*ends, len(text) + 1]), np.array(shifts)

    def move(places: list[int], end: bool) -> list[int]:
        where = np.array(places)
        i = np.searchsorted(last[:-1], where, side="left" if end else "right")
        # parts before i end at or before the place
        within = first[i] < where
        if end:
            new = np.where(within, last[i] + moved_by[np.minimum(i + 1, len(moved_by) - 1)], where + moved_by[i])
        else:
            new = np.where(within, first[i], where) + moved_by[i]
        return new.tolist()

    moved = zip(move([s.start for s in spans], False), move([s.end for s in spans], True), spans)
    return "".join(out), [Span(a, b, s.label) for a, b, s in moved if b > a]


def jitter(text: str, spans: list[Span], seed: int) -> tuple[str, list[Span]]:
    """White space between words varied; formulas, table rows and line breaks stay (GEN-2)."""
    rng = random.Random(seed)
    return rewrite(text, spans, r"(?<=\S) +(?=\S)", lambda m: rng.choice((" ", " ", "  ", "   ")), r"\$[^$\n]*\$|^\|.*$")


def noise(text: str, spans: list[Span], seed: int, share: float = 0.1) -> tuple[str, list[Span]]:
    """Typing errors, wider blanks and changed case in a share of the words (GEN-4, GEN-5)."""
    rng = random.Random(seed)

    def change(m: re.Match) -> str:
        word = m[0]
        if rng.random() >= share:
            return word
        kind, i = rng.randrange(4), rng.randrange(len(word))
        if kind == 0 and len(word) > 1:
            i = min(i, len(word) - 2)
            return word[:i] + word[i + 1] + word[i] + word[i + 2 :]
        if kind == 1 and word[i].lower() in NEIGHBOURS:
            return word[:i] + rng.choice(NEIGHBOURS[word[i].lower()]) + word[i + 1 :]
        return word.upper() if kind == 2 else word.capitalize()

    text, spans = rewrite(text, spans, r"[^\W\d_]+", change, r"\$[^$\n]*\$|<[^>]*>")
    return rewrite(text, spans, r"_{3,}", lambda m: "_" * rng.randint(3, 12)) if "___" in text else (text, spans)


def question(number: int, stem: str, options: list[str], answer: int, seed: int, explanation: str = "") -> tuple[str, list[Span], int]:
    """A question's text, spans and the place of its answer, in a layout and an order of options by the seed (GEN-6, GEN-7)."""
    rng = random.Random(seed)
    order = list(range(len(options)))
    rng.shuffle(order)
    label, gap = rng.choice(LABELS).format(n=number), rng.choice(("\n", "    "))
    text, spans = "", []

    def add(piece: str, name: str | None) -> None:
        nonlocal text
        if name and piece:
            spans.append(Span(len(text), len(text) + len(piece), name))
        text += piece

    add(label, "question_label")
    add(" ", None)
    add(stem, "stem")
    for i, k in enumerate(order):
        add("\n" if i == 0 else gap, None)
        add(f"{chr(65 + i)}.", "option_label")
        add(" ", None)
        add(options[k], "option_text")
    if explanation:
        add("\n", None)
        add(explanation, "explanation")
    return text, spans, order.index(answer)


def exam(questions: list[tuple[str, list[Span]]], gap: str = "\n\n") -> tuple[str, list[Span]]:
    """Questions one after another, with their spans moved (GEN-9)."""
    text, spans = "", []
    for i, (piece, own) in enumerate(questions):
        text += gap if i else ""
        spans += [Span(s.start + len(text), s.end + len(text), s.label) for s in own]
        text += piece
    return text, spans


def ordering_choices(items: list[str], seed: int) -> tuple[list[str], int]:
    """Four orders of the items, one of them right, and its place (GEN-8)."""
    right = tuple(items)
    wrong = [p for p in itertools.permutations(items) if p != right]
    rng = random.Random(seed)
    chosen = [right, *rng.sample(wrong, min(3, len(wrong)))]
    rng.shuffle(chosen)
    return [" - ".join(p) for p in chosen], chosen.index(right)


def answer_grid(answers: str, per_row: int = 10) -> str:
    """A table of numbers and answers (GEN-10)."""
    rows = []
    for lo in range(0, len(answers), per_row):
        part = answers[lo : lo + per_row]
        rows += ["| " + " | ".join(str(lo + i + 1) for i in range(len(part))) + " |", "| " + " | ".join(part) + " |"]
    return "\n".join(rows)


def header(school: str, subject: str, minutes: int, code: str) -> str:
    """The head of an exam paper (GEN-11)."""
    return f"{school.upper()}\nEXAM: {subject.upper()}\nTime: {minutes} minutes\nCode: {code}"


def blueprint(subject: str, total: int, seed: int) -> list[tuple[int, str, str]]:
    """Number, level and difficulty of each task of an exam: easier ones first (GEN-17, GEN-18)."""
    levels = sorted((list(LEVELS)[k] for k in (random.Random(f"{seed}:{subject}").randrange(len(LEVELS)) for _ in range(total))), key=list(LEVELS).index)
    return [(i + 1, level, LEVELS[level]) for i, level in enumerate(levels)]


def style(seed: int) -> dict[str, str]:
    """A seeded choice on each axis (GEN-20)."""
    rng = random.Random(seed)
    return {axis: rng.choice(kinds) for axis, kinds in STYLES.items()}


def random_windows(n: int, sizes: tuple[int, ...], stride_share: float, seed: int) -> list[tuple[int, int]]:
    """Windows whose sizes are drawn one by one (SEQ-8)."""
    rng, out, start = random.Random(seed), [], 0
    while start < n:
        size = rng.choice(sizes)
        out.append((start, min(start + size, n)))
        if start + size >= n:
            break
        start += max(1, int(size * stride_share))
    return out


def absorb_heading(text: str, span: Span) -> Span:
    """A label's start moves over a heading mark before it on its line (TXT-27)."""
    line = text.rfind("\n", 0, span.start) + 1
    return Span(line, span.end, span.label) if re.fullmatch(r"#{1,6} ", text[line : span.start]) else span


def expand_references(text: str, chunks: dict[str, str]) -> tuple[str, int]:
    """[CHUNK_k] and {{C_k}} as their texts, and how many; unknown ones stay (TXT-36, TXT-37)."""
    n = 0

    def one(m: re.Match) -> str:
        nonlocal n
        key = m[1] or m[2]
        if key in chunks:
            n += 1
            return chunks[key]
        return m[0]

    return re.sub(r"\[CHUNK_(\w+)\]|\{\{C_(\w+)\}\}", one, text), n


def project_figures(text: str, expected: list[str]) -> str:
    """Each expected figure once; repeated and unknown ones go, missing ones come at the end (TXT-39)."""
    seen: list[str] = []

    def one(m: re.Match) -> str:
        if m[1] in expected and m[1] not in seen:
            seen.append(m[1])
            return f'<figure id="{m[1]}"/>'
        return ""

    out = re.sub(r'<figure\b[^>]*\bid="([^"]*)"[^>]*/?>', one, text)
    return out + "".join(f'\n<figure id="{x}"/>' for x in expected if x not in seen)


def repeated_prefix(known: str, chunk: str, least: int = 15) -> int:
    """How many characters at a chunk's begin repeat the end of the known text; 0 below least (SEQ-14)."""
    # prefix function of the chunk, then the known text's end run through it
    chunk_fail, k = [0] * len(chunk), 0
    for i in range(1, len(chunk)):
        while k and chunk[i] != chunk[k]:
            k = chunk_fail[k - 1]
        k += chunk[i] == chunk[k]
        chunk_fail[i] = k
    k = 0
    for c in known[-len(chunk) :] if chunk else "":
        while k and (k == len(chunk) or c != chunk[k]):
            k = chunk_fail[k - 1]
        k += c == chunk[k]
    return k if k >= least else 0


def group_questions(spans: list[Span], text: str) -> list[dict]:
    """Questions of ordered spans: label, stem, options, explanation, stimulus before them; no options are made up (SEQ-28, SCR-6)."""
    out: list[dict] = []
    stimulus = None
    for s in sorted(spans, key=lambda s: s.start):
        body = text[s.start : s.end].strip()
        if s.label == "section":
            stimulus = None
        elif s.label == "stimulus":
            stimulus = f"stim_{s.start}_{s.end}"
        elif s.label == "question_label":
            out.append({"id": f"q_{s.start}_{s.end}", "label": body, "stem": None, "options": [], "explanation": None, "stimulus": stimulus})
        elif out and s.label in ("stem", "explanation"):
            out[-1][s.label] = out[-1][s.label] or body
        elif out and s.label == "option_text":
            out[-1]["options"].append(body)
    return out


def protect_atomic(tokens: list[str], tags: list[str]) -> list[str]:
    """Tokens of one <figure ...> tag take the tag of its first token (SEQ-39)."""
    out, inside, first = list(tags), False, "O"
    for i, t in enumerate(tokens):
        if t.startswith("<figure"):
            inside, first = True, tags[i]
        elif inside:
            out[i] = "I-" + first[2:] if first != "O" else "O"
        if inside and t.endswith(">"):
            inside = False
    return out


def decode_figures(rows: list[list[float]], threshold: float, width: float, height: float) -> list[tuple[float, float, float, float, float, int]]:
    """Boxes (x1, y1, x2, y2), score and class of raw detections: logits by a sigmoid, corners kept on the page (SRC-17)."""
    import math

    out = []
    for x1, y1, x2, y2, *logits in rows:
        scores = [1 / (1 + math.exp(-v)) for v in logits]
        best = max(range(len(scores)), key=scores.__getitem__)
        if scores[best] >= threshold:
            out.append((max(0.0, x1), max(0.0, y1), min(width, x2), min(height, y2), scores[best], best))
    return out


def revise(text: str, review: Callable[[str], tuple[str, float]], edit: Callable[[str], str], rounds: int = 3) -> tuple[str, str, float]:
    """Edit and review until it passes or the rounds are over; the best by decision and score stays (SEQ-42)."""
    tier = {"PASS": 2, "NEEDS_REVISION": 1, "DISCARD": 0}
    best = (text, *review(text))
    current = text
    for _ in range(rounds):
        if best[1] == "PASS":
            break
        current = edit(current)
        decision, score = review(current)
        if (tier[decision], score) > (tier[best[1]], best[2]):
            best = (current, decision, score)
    return best


# Tone marks, telex endings, and neighbouring keys.
_TONES = {"\u0300", "\u0301", "\u0303", "\u0309", "\u0323"}
_TELEX = "sfrxjw"
_NEIGHBOURS = {
    "a": "qwsz", "b": "vghn", "c": "xdfv", "d": "ersfxc", "e": "wsdr", "g": "tyfhvb", "h": "yugjbn", "i": "ujko", "k": "ijlm", "l": "kop", "m": "njk", "n": "bhjm",
    "o": "iklp", "p": "ol", "r": "edtf", "s": "wedxza", "t": "rfgy", "u": "yhji", "v": "cfgb", "w": "qase", "x": "zsdc", "y": "tghu", "z": "asx",
}


def typo(word: str, dice: int) -> str:
    """The word with one slip, which a number from 0 on chooses: without tone marks, two letters swapped (from three on), a telex
    ending, or a neighbouring key (from two letters on)."""
    kind, dice = dice % 4, dice // 4
    if kind == 0:
        return unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", word) if c not in _TONES))
    if kind == 1:
        i = dice % max(len(word) - 1, 1)
        return word[:i] + word[i + 1] + word[i] + word[i + 2 :] if len(word) >= 3 else word
    if kind == 2:
        return word + _TELEX[dice % len(_TELEX)]
    keys = [i for i, c in enumerate(word) if c in _NEIGHBOURS]
    if len(word) < 2 or not keys:
        return word
    i = keys[dice % len(keys)]
    return word[:i] + _NEIGHBOURS[word[i]][dice // len(keys) % len(_NEIGHBOURS[word[i]])] + word[i + 1 :]


def typos(text: str, rate: float, seed: str) -> tuple[str, int]:
    """The text with slips in a share of its words, and how many words changed.  Words lie between single spaces; a hash of the
    seed, the word and its place decides, so that the same text gets the same slips (GEN-4)."""
    out, changed = [], 0
    for i, word in enumerate(text.split(" ")):
        dice = zlib.crc32(f"{seed}/{i}/{word}".encode())
        slip = typo(word, zlib.crc32(dice.to_bytes(4, "big"))) if word and dice < rate * 2**32 else word
        changed += slip != word
        out.append(slip)
    return " ".join(out), changed


def typos_of(record: str) -> dict:
    """noisy and changed of a record with doc_id and text."""
    r = json.loads(record)
    noisy, changed = typos(r.get("text") or "", 0.1, str(r.get("doc_id")))
    return {"noisy": noisy, "changed": changed}
