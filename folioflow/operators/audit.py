"""Scores, grades, decisions and roll-ups of audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import PROHIBITED_TAGS

# Grades by least score.
GRADES = ((90, "A"), (80, "B"), (70, "C"), (60, "D"))
# By category, penalties of critical, major and minor issues, and the most that the category may take (35 where none is set).
_TABLE = {
    "unannotated_question": (50.0, 20.0, 10.0, 60.0),
    "stimulus_missing_citation": (25.0, 12.0, 5.0, 25.0),
    "stimulus_nesting": (100.0, 50.0, 20.0, 100.0),
    "single_question_stimulus": (20.0, 10.0, 5.0, 20.0),
    "stimulus_anchor_invalid": (30.0, 15.0, 5.0, 35.0),
    "stimulus_invalid": (30.0, 15.0, 5.0, 35.0),
    "broken_system_tag": (40.0, 15.0, 5.0, 50.0),
    "missing_question_label": (30.0, 15.0, 5.0, 40.0),
    "missing_stem": (35.0, 15.0, 5.0, 35.0),
    "missing_options": (35.0, 15.0, 5.0, 40.0),
    "absorbed_subquestions": (30.0, 15.0, 5.0, 30.0),
    "mislabelled_element": (30.0, 15.0, 5.0, 35.0),
    "prohibited_tags": (40.0, 20.0, 5.0, 40.0),
    "truncated_output": (50.0, 25.0, 10.0, 60.0),
    "xml_syntax": (40.0, 15.0, 5.0, 50.0),
    "schema_conformance": (30.0, 10.0, 5.0, 30.0),
    "stimulus": (30.0, 15.0, 5.0, 35.0),
    "question_structure": (40.0, 15.0, 5.0, 40.0),
    "option_structure": (35.0, 15.0, 5.0, 35.0),
    "verbatim_fidelity": (40.0, 15.0, 5.0, 40.0),
    "conflict_markers": (100.0, 50.0, 20.0, 35.0),
    "llm_semantic": (30.0, 15.0, 5.0, 30.0),
}
PENALTIES = {c: {"CRITICAL": v[0], "MAJOR": v[1], "MINOR": v[2], "INFO": 0.0} for c, v in _TABLE.items()}
CAPS = {c: v[3] for c, v in _TABLE.items()}
#: Penalty of an unknown severity, and the most of an unknown category.
PENALTY, CAP = 5.0, 35.0
SEVERITIES = ("INFO", "MINOR", "MAJOR", "CRITICAL")


def grade(score: Column) -> Column:
    out = F.lit("F")
    for least, name in reversed(GRADES):
        out = F.when(score >= least, name).otherwise(out)
    return out


def decision(score: Column, critical: Column, major: Column, reasons: Column, least: float = 75.0, good: float = 80.0) -> Column:
    """DISCARD for reasons to discard, a low score or a critical issue; then NEEDS_REVISION for a major issue; PASS from good on."""
    return F.when((reasons > 0) | (score < least) | critical, "DISCARD").when(major, "NEEDS_REVISION").when(score >= good, "PASS").otherwise("NEEDS_REVISION")


def composite(syntax: Column, structure: Column, coverage: Column, fidelity: Column, with_source: Column) -> Column:
    """Deterministic score: four parts with a source, two without."""
    return F.when(with_source, 0.25 * syntax + 0.35 * structure + 0.25 * coverage + 0.15 * fidelity).otherwise(0.60 * syntax + 0.40 * structure)


def hybrid(deterministic: Column, semantic: Column) -> Column:
    return 0.40 * deterministic + 0.60 * semantic


def penalty(category: Column, severity: Column) -> Column:
    """Penalty of an issue; unknown categories count as llm_semantic.  The table is a literal map, so nothing is joined."""
    table = F.create_map(*[F.lit(x) for c, by in PENALTIES.items() for s, v in by.items() for x in (f"{c}/{s}", v)])
    return F.coalesce(F.try_element_at(table, F.concat_ws("/", category, severity)), F.try_element_at(table, F.concat_ws("/", F.lit("llm_semantic"), severity)), F.lit(PENALTY))


def cap(category: Column) -> Column:
    """The most that a category may take from the score."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in CAPS.items() for x in pair]), category), F.lit(CAP))


def prohibited_score(text: Column) -> Column:
    """100 less twenty points for each prohibited tag, three of a kind at most."""
    taken = [F.least(F.regexp_count(text, F.lit(rf"(?i)</?{t}(?:\s+[^>]*)?>")), F.lit(3)) for t in PROHIBITED_TAGS]
    return F.greatest(F.lit(0), 100 - 20 * sum(taken[1:], taken[0]))


def adaptive(total: Column, cap: Column, questions: Column) -> Column:
    """Penalty that saturates at its cap, more slowly for documents of many questions."""
    scale = F.greatest(F.lit(1.0), F.sqrt(questions / 10.0))
    return cap * (1 - F.exp(-total / F.greatest(F.lit(1.0), cap * scale)))


def worst(decisions: Column) -> Column:
    """Aggregate: the worst decision."""
    rank = F.max(F.when(decisions == "DISCARD", 2).when(decisions == "NEEDS_REVISION", 1).otherwise(0))
    return F.when(rank == 2, "DISCARD").when(rank == 1, "NEEDS_REVISION").otherwise("PASS")


def span_quality(alignment: Column, valid: Column, complete: Column, offset: Column, length: Column, agreements: Column) -> Column:
    """Quality of a candidate span: alignment, validity, completeness, distance from the chunk's edge, agreement of chunks."""
    edge = F.when(length > 0, F.least(F.lit(1.0), F.least(offset, length - offset) / (length * 0.2 + 1e-5))).otherwise(0.5)
    return (
        0.40 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), alignment)) + 0.25 * F.when(valid, 1.0).otherwise(0.0) + 0.15 * F.when(complete, 1.0).otherwise(0.5)
        + 0.10 * edge + 0.10 * F.least(F.lit(1.0), agreements * 0.5)
    )


def scorecard(df: DataFrame, category: str, score: str, decided: str) -> DataFrame:
    """By category and over all: count, mean score, pass rate and decisions."""
    n = F.count(F.lit(1))
    part = lambda d: F.count_if(F.col(decided) == d)
    return df.rollup(category).agg(
        n.alias("n"), F.round(F.avg(score), 2).alias("mean_score"), F.round(100 * part("PASS") / n, 1).alias("pass_rate"), part("PASS").alias("passed"), part("NEEDS_REVISION").alias("revise"), part("DISCARD").alias("discarded")
    )
