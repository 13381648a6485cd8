"""Parsed-document JSON: elements, chunks, translation items."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewright.functions.text import WS, let, strip

ELEMENT_TYPE = "struct<id:string,type:string,content:string>"
DOCUMENT_TYPE = f"struct<document:struct<elements:array<{ELEMENT_TYPE}>>>"
ITEM_TYPE = "array<struct<idx:string,content:string>>"

# Element types that carry content worth searching or translating.
CONTENT_TYPES = ("text", "table", "section_header")


def document_elements(parsed: Column) -> Column:
    """Typed elements of a parsed document; an empty array if there are none.

    A document with an element that is no object is read again element by
    element, so that only that one is lost; see :func:`unreadable_elements`.
    """
    typed = F.from_json(parsed, DOCUMENT_TYPE)["document"]["elements"]
    good = F.transform(_element_variants(parsed), lambda e: F.try_variant_get(e, "$", ELEMENT_TYPE))
    return F.coalesce(
        typed,
        F.filter(good, lambda e: e.isNotNull()),
        F.array().cast(f"array<{ELEMENT_TYPE}>"),
    )


def _element_variants(parsed: Column) -> Column:
    return F.try_variant_get(F.try_parse_json(parsed), "$.document.elements", "array<variant>")


def unreadable_elements(parsed: Column) -> Column:
    """Number of elements that cannot be read; -1 if the document itself cannot."""
    bad = F.filter(
        _element_variants(parsed), lambda e: ~F.schema_of_variant(e).startswith("OBJECT")
    )
    return F.coalesce(F.size(bad), F.lit(-1))


def to_document_json(elements: Column) -> Column:
    """Inverse of :func:`document_elements`."""
    return F.to_json(F.struct(F.struct(elements.alias("elements")).alias("document")))


def content_chunks(elements: Column) -> Column:
    """array<struct<chunk_id,content>> of the non-empty content elements."""
    kept = F.filter(
        elements, lambda e: e["type"].isin(*CONTENT_TYPES) & (F.length(e["content"]) > 0)
    )
    return F.transform(
        kept,
        lambda e: F.struct(
            F.coalesce(e["id"], F.lit("")).alias("chunk_id"), e["content"].alias("content")
        ),
    )


def last_table(elements: Column) -> Column:
    """HTML of the last non-blank table, with the blanks around it; NULL if the document has none."""
    tables = F.filter(elements, lambda e: (e["type"] == "table") & e["content"].rlike(f"(?U)[^{WS[1:]}"))
    return F.try_element_at(tables, F.lit(-1))["content"]


def translation_items(elements: Column) -> Column:
    """array<struct<idx,type,content>> of the elements to translate.

    ``idx`` is the position in the whole document, so that the translated
    items can be put back by position.
    """
    numbered = F.transform(
        elements,
        lambda e, i: F.struct(
            i.alias("idx"), e["type"].alias("type"), strip(e["content"]).alias("content")
        ),
    )
    return F.filter(
        numbered, lambda e: e["type"].isin(*CONTENT_TYPES) & (F.length(e["content"]) > 0)
    )


def translation_payload(elements: Column) -> Column:
    """The items as JSON text; NULL when there is nothing to translate."""
    return let(translation_items(elements), lambda t: F.when(F.size(t) > 0, F.to_json(t)))


def valid_items(items: Column) -> Column:
    """array<struct<idx:int,content>> of the usable translated items.

    An item needs a content and an ``idx`` that reads as an integer.
    """
    parsed = F.transform(
        items,
        lambda t: F.struct(
            strip(t["idx"]).try_cast("int").alias("idx"), strip(t["content"]).alias("content")
        ),
    )
    return F.filter(parsed, lambda t: t["idx"].isNotNull() & t["content"].isNotNull())


def _by_position(items: Column, use: Callable[[Callable[[Column], tuple[Column, Column]]], Column]) -> Column:
    """Let ``use`` look items up by position: whether there is one, and its content.

    Positions and contents are bound once, the last item first, and a lookup
    is one pass over an array of numbers.
    """

    def bound(positions: Column, contents: Column) -> Column:
        def lookup(i: Column) -> tuple[Column, Column]:
            at = F.array_position(positions, i).cast("int")
            return at > 0, F.get(contents, at - 1)

        return use(lookup)

    last_first = F.reverse(valid_items(items))
    return let(
        last_first,
        lambda ts: let(ts["idx"], lambda ps: let(ts["content"], lambda cs: bound(ps, cs))),
    )


def apply_translations(elements: Column, items: Column) -> Column:
    """Replace element contents by position; among equal positions the last wins.

    Elements without an item keep everything, and replaced ones keep their id
    and type.
    """

    def replaced(lookup: Callable[[Column], tuple[Column, Column]]) -> Column:
        def element(e: Column, i: Column) -> Column:
            found, content = lookup(i)
            return F.struct(
                e["id"].alias("id"),
                e["type"].alias("type"),
                F.when(found, content).otherwise(e["content"]).alias("content"),
            )

        return F.transform(elements, element)

    return _by_position(items, replaced)


def translate_document(parsed: Column, items: Column) -> Column:
    """Document JSON with element contents replaced by position.

    Only the contents change: any other field of an element, the document or
    the envelope is carried over, whatever its type.  Key order may change.
    """
    variant_map = "map<string,variant>"

    def put(m: Column, key: str, value: Column) -> Column:
        rest = F.map_filter(m, lambda k, _: k != key)
        return F.map_concat(rest, F.create_map(F.lit(key), value))

    def rewrite(lookup: Callable[[Column], tuple[Column, Column]], root: Column) -> Column:
        document = root["document"].try_cast(variant_map)
        elements = document["elements"].try_cast(f"array<{variant_map}>")

        def element(e: Column, i: Column) -> Column:
            found, content = lookup(i)
            return F.when(found, put(e, "content", content.cast("variant"))).otherwise(e)

        new = F.transform(elements, element)
        new_document = put(document, "elements", F.to_variant_object(new))
        return F.to_json(put(root, "document", F.to_variant_object(new_document)))

    replaced = _by_position(
        items, lambda look: let(F.from_json(parsed, variant_map), lambda root: rewrite(look, root))
    )
    return F.coalesce(replaced, parsed)


def recover_json_object(reply: Column) -> Column:
    """First candidate in a free-form reply that parses to a JSON object.

    Candidates in order: the whole reply, each fenced block, and the slice
    from the first opening to the last closing brace.  NULL if none is an
    object; arrays and scalars do not count.
    """
    # Fixed value: the fence pattern of the reply format.
    fence = r"(?is)```(?:json)?\s*(.*?)\s*```"

    def candidates(t: Column) -> Column:
        fenced = F.transform(F.regexp_extract_all(t, F.lit(fence), F.lit(1)), strip)
        brace = F.regexp_extract(t, r"(?s)\{.*\}", 0)
        return F.concat(F.array(t), fenced, F.array(brace))

    def is_object(t: Column) -> Column:
        # Only texts that look like an object are worth a parse.
        return t.startswith("{") & F.coalesce(
            F.schema_of_variant(F.try_parse_json(t)).startswith("OBJECT"), F.lit(False)
        )

    return let(strip(reply), lambda t: F.try_element_at(F.filter(candidates(t), is_object), F.lit(1)))


def translation_outcome(original: Column, reply: Column) -> Column:
    """struct<content,source_language,applied> after a translation reply.

    Unreadable reply, English, or no usable item: the original stays.  The
    first two count as English; the last keeps the language the reply named.
    """
    reply_type = f"struct<source_language:string,items:{ITEM_TYPE}>"

    def outcome(content: Column, lang: Column, applied: bool) -> Column:
        return F.struct(
            content.alias("content"),
            lang.alias("source_language"),
            F.lit(applied).alias("applied"),
        )

    def decide(r: Column) -> Column:
        def with_lang(lang: Column) -> Column:
            return (
                F.when(r.isNull() | (lang == "en"), outcome(original, F.lit("en"), False))
                .when(
                    F.coalesce(F.size(valid_items(r["items"])), F.lit(0)) <= 0,
                    outcome(original, lang, False),
                )
                .otherwise(
                    outcome(translate_document(original, r["items"]), lang, True)
                )
            )

        named = F.lower(strip(r["source_language"]))
        return let(
            F.when(F.coalesce(named, F.lit("")) == "", F.lit("en")).otherwise(named), with_lang
        )

    return let(F.from_json(recover_json_object(reply), reply_type), decide)
