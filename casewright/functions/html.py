"""HTML fragments to cells and elements with native expressions."""

from __future__ import annotations

import html as _html
import json
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewright.functions.text import let, squeeze

# What stands before the next closing tag is taken in runs, without a look back: a lazy "." tries the tag at
# every character.
ROW = r"(?is)<tr\b[^>]*+>((?:[^<]++|<(?!/tr>))*+)</tr>"
CELL = r"(?is)<t[dh]\b[^>]*+>((?:[^<]++|<(?!/t[dh]>))*+)</t[dh]>"
TAG = r"<[^>]+>"


@lru_cache(maxsize=1)
def _entity_tables() -> tuple[str, str, str]:
    """Entity tables derived from Python's HTML5 list, as JSON map literals.

    Returns the names ending in a semicolon, the legacy names usable without
    one, and the numeric references below U+00A0, most of which are remapped.
    """
    # Map lookups scan from the front, so the usual names come first.
    usual = ("amp;", "nbsp;", "lt;", "gt;", "quot;", "apos;", "euro;", "pound;")
    names = [*usual, *(n for n in html5 if n.endswith(";") and n not in usual)]
    closed = {n: html5[n] for n in names}
    legacy = {n: v for n, v in html5.items() if not n.endswith(";")}
    low = {str(n): _html.unescape(f"&#{n};") for n in range(160)}
    return json.dumps(closed), json.dumps(legacy), json.dumps(low)


def _map_literal(text: str) -> Column:
    return F.from_json(F.lit(text), "map<string,string>")


def _code_point(n: Column, low: Column) -> Column:
    """Character of a numeric reference, with HTML5's treatment of bad ones."""
    plane_end = n.bitwiseAND(F.lit(0xFFFF))
    return (
        F.when(n < 160, F.try_element_at(low, n.cast("string")))
        .when(((n >= 0xD800) & (n <= 0xDFFF)) | (n > 0x10FFFF), F.lit("�"))
        .when(
            ((n >= 0xFDD0) & (n <= 0xFDEF)) | (plane_end == 0xFFFE) | (plane_end == 0xFFFF),
            F.lit(""),
        )
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
    )


def unescape(c: Column) -> Column:
    """Replace HTML character references in one pass (``&amp;lt;`` -> ``&lt;``).

    The text is cut in front of each ``&``; every piece then starts with at
    most one reference, which is looked up and followed by the rest of the
    piece.  Texts without ``&`` skip all of it.
    """
    closed_json, legacy_json, low_json = _entity_tables()
    legacy_names = sorted(json.loads(legacy_json), key=len, reverse=True)
    legacy_re = "^&(" + "|".join(legacy_names) + ")"
    closed, legacy, low = (_map_literal(t) for t in (closed_json, legacy_json, low_json))

    def cut(piece: Column, ref: Column, value: Column, default: Column) -> Column:
        rest = piece.substr(F.length(ref) + 1, F.length(piece))
        return F.coalesce(F.concat(value, rest), default)

    def named(piece: Column) -> Column:
        by_prefix = let(
            F.regexp_extract(piece, legacy_re, 1),
            lambda n: cut(
                piece, F.concat(F.lit("&"), n), F.try_element_at(legacy, n), piece
            ),
        )
        return let(
            F.regexp_extract(piece, r"^&([^\t\n\f <&#;]{1,32};)", 1),
            lambda n: cut(
                piece, F.concat(F.lit("&"), n), F.try_element_at(closed, n), by_prefix
            ),
        )

    def numeric(piece: Column, pattern: str, base: int) -> Column:
        return let(
            F.regexp_extract(piece, pattern, 0),
            lambda ref: cut(
                piece,
                ref,
                # Digits beyond a long are far outside Unicode, hence U+FFFD.
                let(
                    F.regexp_replace(F.regexp_replace(ref, r"^&#[xX]?0*|;$", ""), "^$", "0"),
                    lambda d: F.when(F.length(d) > 9, F.lit("�")).otherwise(
                        _code_point(F.conv(d, base, 10).cast("long"), low)
                    ),
                ),
                piece,
            ),
        )

    def resolve(piece: Column) -> Column:
        return (
            F.when(piece.rlike(r"^&#[0-9]"), numeric(piece, r"^&#[0-9]+;?", 10))
            .when(piece.rlike(r"^&#[xX][0-9a-fA-F]"), numeric(piece, r"^&#[xX][0-9a-fA-F]+;?", 16))
            .when(piece.startswith("&"), named(piece))
            .otherwise(piece)
        )

    return let(
        c,
        lambda t: F.when(
            t.contains("&"), F.array_join(F.transform(F.split(t, "(?=&)"), resolve), "")
        ).otherwise(t),
    )


def cell_text(c: Column) -> Column:
    """Visible text of an HTML fragment: no tags, no references, squeezed."""
    untagged = F.when(c.contains("<"), F.regexp_replace(c, TAG, " ")).otherwise(c)
    return squeeze(unescape(untagged))


def raw_rows(c: Column) -> Column:
    """array<string>: inner HTML of the rows of a table."""
    return F.regexp_extract_all(c, F.lit(ROW), F.lit(1))


def raw_cells(row: Column) -> Column:
    """array<string>: inner HTML of the cells of a row."""
    return F.regexp_extract_all(row, F.lit(CELL), F.lit(1))


def table_cells(c: Column) -> Column:
    """array<array<string>>: rows of a table, each an array of cell texts.

    Rows without cells are kept as empty arrays, so a caller can tell a row
    without cells from a missing row.
    """
    return F.transform(raw_rows(c), lambda row: F.transform(raw_cells(row), cell_text))


# --- whole pages ------------------------------------------------------------

_HIDDEN = r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->"
_BLOCK = (
    "h[1-6]|p|li|ul|ol|dl|div|table|article|section|aside|nav|main|header|footer|"
    "form|blockquote|pre|head|body|html"
)
# One alternation, so elements come out in document order.  A paragraph, item
# or heading ends where the next block tag begins: raw pages often leave the
# closing tag out.  A table is kept whole.
_ELEMENT = (
    r"(?is)<table\b[^>]*>.*?</table\s*>"
    rf"|<(?:h[1-6]|p|li)\b[^>]*>.*?(?=</?(?:{_BLOCK})\b|\z)"
)


def page_elements(c: Column) -> Column:
    """array<struct<id,type,content>> of a raw HTML page, in document order."""
    raw = F.regexp_extract_all(F.regexp_replace(c, _HIDDEN, " "), F.lit(_ELEMENT), F.lit(0))
    typed = F.transform(
        raw,
        lambda e: let(
            F.lower(F.regexp_extract(e, r"^<([a-zA-Z]+)", 1)),
            lambda tag: F.struct(
                F.when(tag == "table", F.lit("table"))
                .when(tag == "h", F.lit("section_header"))
                .otherwise(F.lit("text"))
                .alias("type"),
                F.when(tag == "table", e).otherwise(cell_text(e)).alias("content"),
            ),
        ),
    )
    kept = F.filter(typed, lambda e: e["content"] != "")
    return F.transform(
        kept,
        lambda e, i: F.struct(
            i.cast("string").alias("id"), e["type"].alias("type"), e["content"].alias("content")
        ),
    )
