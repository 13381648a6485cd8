"""Text cleaning, tokenising and chunking.

Whitespace and word characters follow Unicode, as they do in Python's ``re``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace, including the four separators U+001C..U+001F.  Patterns
# with it need the (?U) flag; listing the code points instead is four times
# slower.
WS = r"[\s\x1c-\x1f]"
# The same set character by character, for trimming without a regex.
SPACE_CHARS = "".join(chr(n) for n in range(0x3001) if chr(n).isspace())
# Letters, numbers of every kind and the underscore; the plain ones come first
# because they are found by a table lookup.
WORD = r"[a-zA-Z0-9_\p{L}\p{N}]"
TOKEN = r"[a-z0-9\p{L}\p{N}]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``.

    A lambda variable is evaluated a single time per row, whereas repeating a
    costly expression (a JSON parse, a regex) in one tree would repeat the work.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def built_once(build: Callable[..., Column]) -> Callable[..., Column]:
    """Keep the columns a builder returns for given column names.

    A large expression takes hundreds of calls into the JVM to build, and the
    result can be shared by any number of plans of the same JVM.
    """
    kept: dict[tuple, Column] = {}

    def get(*names: str) -> Column:
        key = (SparkContext._gateway, *names)
        if key not in kept:
            kept[key] = build(*names)
        return kept[key]

    return get


def strip(c: Column) -> Column:
    """Remove Unicode whitespace on both ends."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def squeeze(c: Column) -> Column:
    """Turn every whitespace run into one blank and strip the ends."""
    return F.trim(F.regexp_replace(c, f"(?U){WS}+", " "))


def clean_text(c: Column) -> Column:
    """Join words hyphenated over a line break, then squeeze whitespace.

    Line breaks are whitespace too, so one squeeze covers both of the
    "newline to blank" and "runs to one blank" steps.
    """
    joined = F.regexp_replace(c, f"(?U)({WORD})-{WS}*\\n{WS}*({WORD})", "$1$2")
    # A cheap test first: few texts have a hyphen before a line break.
    return squeeze(F.when(c.rlike(f"(?U)-{WS}*\\n"), joined).otherwise(c))


def tokens(c: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))


def word_count(c: Column) -> Column:
    """Number of whitespace-separated words."""
    return let(
        strip(c), lambda t: F.when(t == "", 0).otherwise(F.size(F.split(t, f"(?U){WS}+")))
    )


def token_estimate(c: Column) -> Column:
    """Rule of thumb: four characters per token, rounded down."""
    return F.floor(F.length(c) / 4).cast("long")


def excerpt(c: Column, size: int = 200, missing: str = "N/A") -> Column:
    """Leading characters followed by an ellipsis; ``missing`` for NULL."""
    return F.coalesce(F.concat(F.substring(c, 1, size), F.lit("...")), F.lit(missing))


def preview(c: Column, size: int = 300) -> Column:
    """Leading characters with line breaks shown as the two characters ``\\n``."""
    return F.replace(F.substring(c, 1, size), F.lit("\n"), F.lit("\\n"))


def nonblank_lines(c: Column) -> Column:
    """Stripped lines of a text without the blank ones."""
    return F.filter(F.transform(F.split(strip(c), "\n"), strip), lambda s: s != "")


# --- chunking -------------------------------------------------------------


def fixed_chunks(c: Column, size: int = 500, overlap: int = 50) -> Column:
    """array<struct<start,text>> of fixed-size windows over the characters.

    A window starts every ``size - overlap`` characters while the start lies
    inside the text, so the last window may be contained in the one before.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be in [0, size)")
    step = size - overlap
    starts = F.sequence(F.lit(0), F.length(c) - 1, F.lit(step))
    empty = F.array().cast("array<struct<start:int,text:string>>")
    windows = F.transform(
        starts,
        lambda s: F.struct(
            s.alias("start"), c.substr(s + F.lit(1), F.lit(size)).alias("text")
        ),
    )
    return F.when(F.length(c) > 0, windows).otherwise(empty)


def sentences(c: Column) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by whitespace."""
    return F.split(c, f"(?U)(?<=[.!?]){WS}+")


def sentence_chunks(c: Column, max_sentences: int = 5) -> Column:
    """array<string>: groups of ``max_sentences`` sentences joined by a blank."""
    if max_sentences < 1:
        raise ValueError("max_sentences must be positive")
    return let(
        sentences(c),
        lambda s: F.transform(
            F.sequence(F.lit(1), F.size(s), F.lit(max_sentences)),
            lambda i: F.array_join(F.slice(s, i, F.lit(max_sentences)), " "),
        ),
    )


def paragraph_chunks(c: Column, separator: str = "\n\n", budget: int = 512) -> Column:
    """array<string>: whole paragraphs packed greedily up to a token budget.

    Paragraphs are stripped and blank ones dropped.  One that is larger than
    the budget on its own becomes a chunk of its own and is never cut.
    """
    literal = "\\Q" + separator + "\\E"
    paragraphs = F.filter(F.transform(F.split(c, literal), strip), lambda p: p != "")
    # The accumulator keeps only chunk boundaries (1-based start positions); the
    # texts are sliced out once at the end instead of being copied at each step.
    start = F.struct(
        F.array().cast("array<int>").alias("starts"),
        F.lit(0).alias("at"),
        F.lit(0).cast("long").alias("used"),
    )

    def step(acc: Column, cost: Column) -> Column:
        opens = (acc["at"] == 0) | (acc["used"] + cost > budget)
        return F.struct(
            F.when(opens, F.array_append(acc["starts"], acc["at"] + 1))
            .otherwise(acc["starts"])
            .alias("starts"),
            (acc["at"] + 1).alias("at"),
            F.when(opens, cost).otherwise(acc["used"] + cost).alias("used"),
        )

    def build(ps: Column) -> Column:
        bounds = F.aggregate(F.transform(ps, token_estimate), start, step)["starts"]
        return let(
            bounds,
            lambda b: F.transform(
                b,
                lambda s, i: F.array_join(
                    F.slice(
                        ps,
                        s,
                        F.coalesce(F.get(b, i + 1), F.size(ps) + 1) - s,
                    ),
                    separator,
                ),
            ),
        )

    return let(paragraphs, build)
