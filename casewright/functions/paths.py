"""Case, document and role from a file path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewright.functions.text import let

ROLES = ("invoice", "declaration", "royalty")


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def case_id(path: Column) -> Column:
    """Deepest path part that starts with ``case_``, else the bare file name.

    Only this lookup treats a backslash as a separator.
    """
    parts = F.filter(
        F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"),
        lambda p: p.startswith("case_"),
    )
    return F.coalesce(F.try_element_at(parts, F.lit(-1)), document_id(path))


def document_id(path: Column) -> Column:
    """File name without any ``.pdf`` (case-sensitive)."""
    return F.replace(basename(path), F.lit(".pdf"), F.lit(""))


def case_folder(path: Column) -> Column:
    """Name of the folder that holds the file; NULL unless it is a case folder."""
    return let(
        F.try_element_at(F.split(path, "/"), F.lit(-2)),
        lambda d: F.when(d.startswith("case_"), d),
    )


def role(path: Column, ignore_case: bool = True) -> Column:
    """invoice, declaration or royalty by file name prefix, else NULL."""
    name = F.lower(basename(path)) if ignore_case else basename(path)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for r in ROLES:
        out = out.when(name.startswith(f"{r}_"), F.lit(r))
    return out
