"""Text functions as Column expressions; offsets and lengths are in code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tags of annotated documents, and of pages.
ANNOTATION_TAGS = ("section", "question", "question_label", "stem", "option_label", "option_text", "explanation", "stimulus")
SEQUENCE_TAGS = ("question_label", "stem", "option_label", "option_text", "other")
PROHIBITED_TAGS = ("page_metadata", "pages", "page", "think")
PRESENTATION_TAGS = ("center", "font", "footer", "header", "t", "aside", "nav", "mark", "marquee", "strike", "s", "del", "ins", "small", "big")
VOID_TAGS = ("br", "hr", "img", "input", "meta", "link")

#: A word or a symbol, as Python's Unicode classes have it, in a form that Java and RE2 share.
WORD = r"[\p{L}\p{N}_]+"
TOKEN = rf"{WORD}|[^\p{{L}}\p{{N}}_\s]"


def _lit(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(text: str | Column) -> Column:
    """Words and single symbols."""
    return F.regexp_extract_all(_lit(text), F.lit(TOKEN), F.lit(0))


def token_count(text: str | Column) -> Column:
    """How many words and single symbols there are, without making an array of them."""
    return F.regexp_count(_lit(text), F.lit(TOKEN))


def words(text: str | Column) -> Column:
    return F.regexp_extract_all(_lit(text), F.lit(WORD), F.lit(0))


def strip_blank(text: str | Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(_lit(text), r"^\s+|\s+$", "")


def collapse_blank(text: str | Column) -> Column:
    """Words joined by single spaces."""
    return F.trim(F.regexp_replace(_lit(text), r"\s+", " "))


def split_words(text: str | Column) -> Column:
    """Words between white space; none in a blank text."""
    line = collapse_blank(text)
    return F.when(line == "", F.array().cast("array<string>")).otherwise(F.split(line, " "))


def strip_tags(text: str | Column, names: tuple[str, ...]) -> Column:
    """Without opening and closing tags of these names, in any case, with attributes."""
    return F.regexp_replace(_lit(text), rf"(?i)</?(?:{'|'.join(names)})(?:\s[^>]*)?/?>", "")


def strip_annotations(text: str | Column) -> Column:
    """Without the tags of annotations, whatever follows their names."""
    return F.regexp_replace(_lit(text), rf"(?i)</?(?:{'|'.join(ANNOTATION_TAGS)})[^>]*>", "")


def strip_sequence_tags(text: str | Column) -> Column:
    """Without tags of sequence labels; blank lines squeezed, trimmed, with a line break at the end."""
    return F.concat(strip_blank(squeeze_lines(F.regexp_replace(_lit(text), rf"(?i)</?(?:{'|'.join(SEQUENCE_TAGS)})\b[^>]*>", ""))), F.lit("\n"))


def strip_page_markup(text: str | Column) -> Column:
    """Without page tags and their metadata, closed or not, and without metadata in comments."""
    out = F.regexp_replace(_lit(text), r"(?is)(?:<\|page_metadata\|>|<page_metadata>)\s*.*?(?:<\|end_metadata\|>|</page_metadata>|(?=</page>)|(?=<page\b)|$)", "")
    out = F.regexp_replace(out, r"(?s)<!--\s*PAGE_METADATA_START.*?PAGE_METADATA_END\s*-->", "")
    return strip_blank(F.regexp_replace(out, r"(?i)</?pages?\b[^>]*>", ""))


def sanitise_for_merge(text: str | Column) -> Column:
    """Without metadata, page tags and end marks; blank lines squeezed, the end trimmed."""
    out = F.regexp_replace(_lit(text), r"</?page_metadata>\s*\{[\s\S]*?\}\s*</?page_metadata>", "")
    out = F.regexp_replace(F.regexp_replace(out, r"<page_metadata>[\s\S]*?</page_metadata>", ""), r"</?(?:pages?|page_metadata)>", "")
    return squeeze_lines(F.regexp_replace(F.regexp_replace(out, r"<\|(?:END|endoftext)\|>", ""), r"\s+$", ""))


def strip_prohibited(text: str | Column) -> tuple[Column, Column]:
    """The text without metadata blocks, prohibited and presentation tags; and the names of what was found, in that order."""
    out, found = _lit(text), []
    block = r"(?i)<page_metadata>[\s\S]*?</page_metadata>"
    found.append(F.when(out.rlike(block), F.lit("block")))
    out = F.regexp_replace(out, block, "")
    for tag in (*PROHIBITED_TAGS, *PRESENTATION_TAGS):
        found.append(F.when(out.rlike(rf"(?i)</?{tag}(?:\s+[^>]*)?>"), F.lit(tag)))
    for tags in (PROHIBITED_TAGS, PRESENTATION_TAGS):
        out = F.regexp_replace(out, rf"(?i)</?(?:{'|'.join(tags)})(?:\s+[^>]*)?>", "")
    return out, F.array_compact(F.array(*found))


def strip_all_tags(text: str | Column) -> Column:
    """Without comments and tags; a bare < before anything but a letter, / or ! stays."""
    return F.regexp_replace(F.regexp_replace(_lit(text), r"(?s)<!--.*?-->", ""), r"</?[A-Za-z][^>]*>", "")


def squeeze_lines(text: str | Column) -> Column:
    """At most one blank line in a row."""
    return F.regexp_replace(_lit(text), r"\n{3,}", "\n\n")


def close_void_tags(text: str | Column) -> Column:
    """Void tags written as self-closing ones."""
    return F.regexp_replace(_lit(text), rf"(?i)<({'|'.join(VOID_TAGS)})((?:\s[^<>/]*)?)\s*>", "<$1$2/>")


def repair_inequality(text: str | Column) -> Column:
    """<24> is an inequality, not a tag: it becomes ' < 24'."""
    return F.regexp_replace(_lit(text), r"<\s*(\d+)\s*>", " < $1")


def clean_reply(text: str | Column) -> Column:
    """A model's reply without thoughts (closed or not) and code fences."""
    closed = F.regexp_replace(_lit(text), r"(?s)<think>.*?</think>", "")
    return strip_blank(F.regexp_replace(F.regexp_replace(closed, r"(?s)<think>.*$", ""), r"```[A-Za-z]*\n?", ""))


def latex_class(formula: str | Column) -> Column:
    """Typed class of a formula: by relation signs, else by length."""
    body = strip_blank(F.regexp_replace(_lit(formula), r"^\$+|\$+$", ""))
    size = F.length(body)
    return (
        F.when(body.rlike(r"=|\\approx|\\equiv"), "[MATH_CALC]")
        .when(size <= 3, "[MATH_VAR_SHORT]")
        .when(size <= 10, "[MATH_VAR_MED]")
        .when(size <= 30, "[MATH_EXPR_SHORT]")
        .otherwise("[MATH_EXPR_LONG]")
    )


def truncate(text: str | Column, budget: int, per_token: int = 4, marker: str = " ...") -> Column:
    """The text if it is within budget tokens of per_token characters, else cut at the last space, with a marker."""
    text, room = _lit(text), budget * per_token
    cut = F.regexp_replace(F.substring(text, 1, room), r" +[^ ]*\z", "")
    return F.when(F.length(text) <= room, text).otherwise(F.concat(cut, F.lit(marker)))


def token_estimate(text: str | Column, per_token: float = 3.2) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(_lit(text)) / per_token)).cast("long")


def is_valid_chunk(text: str | Column, min_chars: int = 12, min_words: int = 3) -> Column:
    """Long enough, no lone label, three letters or digits, enough words (or one long word in capitals)."""
    body = strip_blank(text)
    alnum = F.length(F.regexp_replace(body, r"[^\p{L}\p{N}]", ""))
    capital = (F.length(body) >= 8) & (body == F.upper(body)) & (body != F.lower(body))
    return (F.length(body) >= min_chars) & ~body.rlike(r"^(?:[A-D]\.|\d+\.)$") & (alnum >= 3) & ((F.size(split_words(text)) >= min_words) | capital)


def without_blank(text: str | Column) -> Column:
    return F.regexp_replace(_lit(text), r"\s+", "")


def verbatim(text: str | Column) -> Column:
    """Key of verbatim equality: no tags, no white space."""
    return without_blank(strip_all_tags(text))


def has_conflict_markers(text: str | Column) -> Column:
    return _lit(text).rlike(r"(?m)^(?:<{5,9}|={5,9}|>{5,9})")


def tag_attributes(tag: str | Column) -> Column:
    """Map of k="v" attributes."""
    tag = _lit(tag)
    pattern = r'([A-Za-z_][A-Za-z0-9_-]*)="([^"]*)"'
    return F.map_from_entries(F.array_distinct(F.arrays_zip(F.regexp_extract_all(tag, F.lit(pattern), F.lit(1)).alias("k"), F.regexp_extract_all(tag, F.lit(pattern), F.lit(2)).alias("v"))))


def cooldown_seconds(text: str | Column, default: int = 0) -> Column:
    """Seconds until a cap is lifted: a duration after 'resets in' or 'try again in', else hours and minutes (with seconds)
    anywhere, else 'retry-after', 60 at least; default where there is none."""
    text = _lit(text)

    def sum_of(parts: list[Column]) -> Column:
        h, m, s = [F.when(x == "", 0).otherwise(x.try_cast("long")) for x in parts]
        return h * 3600 + m * 60 + s

    after = r"(?i)(?:resets?\s*in|try\s*again\s*in)\s*(?:(\d+)\s*h(?:ours?|rs?)?)?\s*(?:(\d+)\s*m(?:in(?:ute)?s?)?)?\s*(?:(\d+)\s*s(?:ec(?:ond)?s?)?)?"
    first = sum_of([F.regexp_extract(text, after, i) for i in (1, 2, 3)])
    found = [F.regexp_extract(text, rf"(?i)(\d+)\s*(?:{x})", 1) for x in (r"hours?|hrs?|h\b", r"minutes?|mins?|m\b", r"seconds?|secs?|s\b")]
    second = F.when((found[0] != "") | (found[1] != ""), sum_of(found))
    retry = F.regexp_extract(text, r"(?i)retry[-_ ]after[:\s]+(\d+)", 1)
    third = F.when(retry != "", F.greatest(F.lit(60), retry.try_cast("long")))
    return F.coalesce(F.when(first > 0, first), F.when(second > 0, second), third, F.lit(default)).cast("long")


def ordinals(label: str | Column) -> Column:
    """All readings of a label as a number: digits, letter, roman numeral."""
    label = F.upper(_lit(label))
    roman = F.element_at(F.create_map(*[F.lit(x) for pair in zip(("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X"), range(1, 11), strict=True) for x in pair]), label)
    letter = F.when(label.rlike("^[A-Z]$"), F.ascii(label) - 64)
    digits = F.when(label.rlike(r"^\d+$"), label.try_cast("int"))
    return F.array_distinct(F.array_compact(F.array(digits, letter, roman)))


def stable_seed(text: str | Column) -> Column:
    """Polynomial hash of base 31 over code points, modulo 2^32."""
    chars = F.filter(F.split(_lit(text), ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(0).cast("long"), lambda a, c: (a * 31 + F.ascii(c)) % 4294967296)


def is_dev(doc_id: str | Column, ratio: float, seed: str = "42") -> Column:
    """Hash split by document: parts and augmented twins of a document are on its side."""
    base = F.regexp_replace(F.split_part(_lit(doc_id).cast("string"), F.lit("::"), F.lit(1)), "_aug$", "")
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), base)), 1, 8), 16, 10).cast("long") / F.lit(4294967295.0) < ratio
