"""Answer scorers: one boolean or number Column per scorer."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewright.functions.text import word_count

# The word lists and patterns the scorers look for.
DOCUMENT_KEYWORDS = (
    "invoice",
    "royalty",
    "declaration",
    "valuation",
    "invoice total",
    "vat",
    "currency",
)
FIELD_KEYWORDS = (
    "case_id",
    "invoice total",
    "declaration total",
    "declaration invoice total",
    "royalty percentage",
    "declaration royalty",
    "anomaly",
    "mismatch",
)
ANOMALY_LABELS = (
    "invoice_total_mismatch",
    "declaration_total_mismatch",
    "royalty_mismatch",
)
CASE_PATTERN = r"\bcase[-_ ]?id\b|\bcase\s*[=:]\s*[a-z0-9_-]+"
NUMBER_PATTERN = r"\b\d+(?:\.\d+)?%\b|\b\$?\d+(?:,\d{3})*(?:\.\d+)?\b"
SOURCE_KEYWORDS = ("source", "document")
MAX_WORDS = 350
IDEAL_WORDS = (50, 200)


def contains_any(c: Column, needles: Iterable[str]) -> Column:
    """True if any needle occurs; needles containing another needle add nothing."""
    needles = sorted(set(needles), key=len)
    minimal = [n for i, n in enumerate(needles) if not any(m in n for m in needles[:i])]
    out = F.lit(False)
    for n in minimal:
        out = out | c.contains(n)
    return out


def under_word_limit(answer: Column) -> Column:
    return word_count(answer) < MAX_WORDS


def mentions_documents(answer: Column) -> Column:
    return contains_any(F.lower(answer), DOCUMENT_KEYWORDS)


def evidence_signals(answer: Column) -> Column:
    """0..5: fields, labels, a case reference, a number, a source."""
    lowered = F.lower(answer)
    signals = (
        contains_any(lowered, FIELD_KEYWORDS),
        contains_any(lowered, ANOMALY_LABELS),
        lowered.rlike("(?U)" + CASE_PATTERN),
        answer.rlike("(?U)" + NUMBER_PATTERN),
        contains_any(lowered, SOURCE_KEYWORDS),
    )
    total = F.lit(0)
    for s in signals:
        total = total + s.cast("int")
    return total


def reflects_anomaly_check(answer: Column) -> Column:
    return contains_any(F.lower(answer), (*ANOMALY_LABELS, "anomaly", "mismatch"))


def has_code_example(answer: Column) -> Column:
    return answer.contains("```") | F.lower(answer).contains("python")


def length_score(answer: Column) -> Column:
    """1 for an ideal length, falling linearly to 0 on both sides."""
    n = word_count(answer)
    low, high = IDEAL_WORDS
    return (
        F.when(n.between(low, high), F.lit(1.0))
        .when(n < low, n / low)
        .otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - (n - high) / high))
    )


def answer_scores(answer: Column) -> dict[str, Column]:
    """All scorers by name."""
    return {
        "word_count_check": under_word_limit(answer),
        "mentions_valuation_docs": mentions_documents(answer),
        "evidence_citations": evidence_signals(answer),
        "uses_detect_anomalies": reflects_anomaly_check(answer),
        "has_code_example": has_code_example(answer),
        "response_length_score": length_score(answer),
    }
