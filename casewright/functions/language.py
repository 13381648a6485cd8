"""Language of a text from stop-word counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewright.functions.text import let, tokens

# Frequent function words, each listed under one language only.
STOP_WORDS = {
    "en": ("the", "and", "of", "to", "is", "that", "it", "for", "with", "this", "by", "are"),
    "fr": ("le", "les", "et", "des", "une", "du", "est", "dans", "pour", "sur", "avec", "qui"),
    "de": ("der", "die", "und", "das", "den", "mit", "ist", "nicht", "von", "ein", "auf", "zu"),
    "es": ("el", "los", "las", "y", "por", "con", "para", "una", "del", "se", "como", "su"),
}


def detect_language(c: Column) -> Column:
    """ISO code with the most stop words; ties and zero go to the list order.

    Runs inside the row: no token table, no join, no shuffle.
    """

    def count(ts: Column, words: tuple[str, ...]) -> Column:
        return F.size(F.filter(ts, lambda t: t.isin(*words)))

    def decide(ts: Column) -> Column:
        # greatest() over (count, -position) structs keeps the earliest on ties
        best = F.greatest(
            *[
                F.struct(
                    count(ts, words).alias("n"),
                    F.lit(-i).alias("preference"),
                    F.lit(code).alias("code"),
                )
                for i, (code, words) in enumerate(STOP_WORDS.items())
            ]
        )
        return best["code"]

    return let(tokens(c), decide)
