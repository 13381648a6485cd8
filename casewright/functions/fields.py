"""Money fields of invoices, declarations and royalty agreements."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewright.functions.elements import last_table
from casewright.functions.html import cell_text, raw_cells, raw_rows
from casewright.functions.paths import role
from casewright.functions.text import let, strip

# Declaration rows are recognised by a substring of the label.  The order is
# the priority: the first match wins, so "total invoice" is the invoice amount.
DECLARATION_LABELS = (
    ("invoice", "declaration_invoice_total"),
    ("tax a", "declaration_tax_A"),
    ("tax b", "declaration_tax_B"),
    ("vat", "declaration_VAT"),
    ("royalty", "declaration_royalty"),
    ("total", "declaration_total"),
)

FIELD_TYPES = {
    "invoice_total": "double",
    "invoice_currency": "string",
    **{name: "double" for _, name in DECLARATION_LABELS},
    "declaration_currency": "string",
    "royalty_percentage": "double",
}


def parse_number(c: Column) -> Column:
    """Text to double: blanks around, underscores between digits, nan and inf.

    No thousands separators and no type suffixes; anything else is NULL.
    Plain digits, by far the most common, take one test and one cast.
    """
    simple = c.rlike(r"^-?[0-9]+(\.[0-9]+)?$")

    def convert(t: Column) -> Column:
        plain = t.rlike(r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$")
        unsigned = F.regexp_replace(t, "^[+-]", "")
        negative = t.startswith("-")
        inf = F.lit(float("inf"))
        return (
            F.when(plain, F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))
            .when(unsigned.isin("inf", "infinity"), F.when(negative, -inf).otherwise(inf))
            .when(unsigned == "nan", F.lit(float("nan")))
        )

    return F.when(simple, c.try_cast("double")).otherwise(let(F.lower(strip(c)), convert))


def invoice_fields(elements: Column, amount_col: int = 6, currency_col: int = 7) -> Column:
    """struct<amount,currency> from the last row of the last table.

    Columns count from 1 and must be 1..9.  Both fields are NULL together when
    either cannot be read.
    """
    none = F.struct(
        F.lit(None).cast("double").alias("amount"), F.lit(None).cast("string").alias("currency")
    )
    if not (1 <= amount_col <= 9 and 1 <= currency_col <= 9):
        return none

    def read(cells: Column) -> Column:
        amount = parse_number(F.get(cells, F.lit(0)))
        currency = F.upper(F.get(cells, F.lit(1)))
        return let(
            F.struct(amount.alias("amount"), currency.alias("currency")),
            lambda f: F.when(f["amount"].isNotNull() & f["currency"].isNotNull(), f).otherwise(none),
        )

    # Only the two cells in question are turned into text.
    last_row = raw_cells(F.try_element_at(raw_rows(last_table(elements)), F.lit(-1)))
    wanted = let(
        last_row,
        lambda r: F.array(F.get(r, F.lit(amount_col - 1)), F.get(r, F.lit(currency_col - 1))),
    )
    return F.coalesce(let(F.transform(wanted, cell_text), read), none)


def declaration_rows(rows: Column) -> Column:
    """array<struct<field,amount,raw,currency>> of the rows below the header.

    ``rows`` holds the raw cells of all non-empty rows.  Rows with fewer than
    three cells carry no amount: they have a NULL field and a NULL raw text.
    """

    def label_field(label: Column) -> Column:
        out = F.when(F.lit(False), F.lit(None).cast("string"))
        for needle, field in DECLARATION_LABELS:
            out = out.when(label.contains(needle), F.lit(field))
        return out

    def read(texts: Column) -> Column:
        raw = F.get(texts, F.lit(1))
        return F.struct(
            F.when(
                raw.isNotNull(), let(F.lower(F.get(texts, F.lit(0))), label_field)
            ).alias("field"),
            parse_number(raw).alias("amount"),
            raw.alias("raw"),
            F.get(texts, F.lit(2)).alias("currency"),
        )

    # Label, amount and currency are the only cells turned into text.
    return F.transform(
        rows,
        lambda r: let(
            F.transform(
                F.array(F.get(r, F.lit(0)), F.get(r, F.lit(2)), F.get(r, F.lit(3))), cell_text
            ),
            read,
        ),
    )


def declaration_fields(elements: Column) -> Column:
    """struct of the six declared amounts, the currency and unreadable amounts.

    Later rows overwrite earlier ones of the same label.  An amount that cannot
    be read leaves its field NULL and is listed in ``bad_amounts``; it never
    stops the job.
    """

    def collect(rows: Column) -> Column:
        # The header never counts as an amount, but if it is the only row it is
        # also the last one and gives the currency.
        entries = F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0)))

        def read(found: Column) -> Column:
            def last(field: str) -> Column:
                hits = F.filter(found, lambda e: e["field"] == field)
                return F.try_element_at(hits, F.lit(-1))["amount"].alias(field)

            currency = F.upper(F.try_element_at(rows, F.lit(-1))["currency"])
            bad = F.filter(found, lambda e: e["raw"].isNotNull() & e["amount"].isNull())
            return F.struct(
                *[last(field) for _, field in DECLARATION_LABELS],
                F.when(currency != "", currency).alias("declaration_currency"),
                F.transform(bad, lambda e: e["raw"]).alias("bad_amounts"),
            )

        return let(entries, read)

    raw = F.coalesce(raw_rows(last_table(elements)), F.array().cast("array<string>"))
    rows = F.filter(F.transform(raw, raw_cells), lambda r: F.size(r) > 0)
    return let(declaration_rows(rows), collect)


def royalty_percentage(elements: Column) -> Column:
    """First percentage in element order, whatever the element type."""
    found = F.transform(
        elements,
        lambda e: F.regexp_extract(
            F.coalesce(e["content"], F.lit("")), r"(?U)(\d+(?:[.,]\d+)?)\s*%", 1
        ),
    )
    first = F.try_element_at(F.filter(found, lambda t: t != ""), F.lit(1))
    # The pattern knows the decimal digits of all scripts, the cast only those of ASCII.
    return F.translate(first, "," + _DIGITS, "." + _VALUES).try_cast("double")


_DIGITS = "".join(c for c in map(chr, range(128, 0x10000)) if unicodedata.category(c) == "Nd")
_VALUES = "".join(str(unicodedata.digit(c)) for c in _DIGITS)


def structured_metadata(path: Column, elements: Column) -> Column:
    """Struct of the ten fields; the file name decides which ones are read.

    ``bad_amounts`` comes along as an eleventh field for the quarantine.
    """

    def pack(values: dict[str, Column], bad: Column) -> Column:
        return F.struct(
            *[
                values.get(name, F.lit(None)).cast(kind).alias(name)
                for name, kind in FIELD_TYPES.items()
            ],
            bad.alias("bad_amounts"),
        )

    no_bad = F.array().cast("array<string>")
    kind = role(path)
    invoice = let(
        invoice_fields(elements),
        lambda f: pack({"invoice_total": f["amount"], "invoice_currency": f["currency"]}, no_bad),
    )
    declaration = let(
        declaration_fields(elements),
        lambda f: pack(
            {n: f[n] for n in FIELD_TYPES if n.startswith("declaration_")}, f["bad_amounts"]
        ),
    )
    royalty = pack({"royalty_percentage": royalty_percentage(elements)}, no_bad)
    return (
        F.when(kind == "invoice", invoice)
        .when(kind == "declaration", declaration)
        .when(kind == "royalty", royalty)
        .otherwise(pack({}, no_bad))
    )
