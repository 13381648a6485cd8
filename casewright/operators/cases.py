"""Case inventory, field extraction, case rollup and the chunk table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.functions import paths
from casewright.functions.elements import content_chunks, document_elements, unreadable_elements
from casewright.functions.fields import FIELD_TYPES, structured_metadata
from casewright.functions.text import built_once, clean_text

PATH_COLUMNS = tuple(f"{r}_path" for r in paths.ROLES)


def case_inventory(files: DataFrame) -> DataFrame:
    """One row per case folder with the path of each role, from a file listing.

    The role prefix is case-sensitive here, the ``.pdf`` ending is not.  If a
    role has several files the greatest path is taken, whatever the listing
    order.
    """
    path = F.col("path")
    is_pdf = F.lower(path).endswith(".pdf")
    role = paths.role(path, ignore_case=False)
    return (
        files.withColumn("id", paths.case_folder(path))
        .where(F.col("id").isNotNull())
        .withColumn("role", F.when(is_pdf, role))
        .groupBy("id")
        .agg(
            *[
                F.max(F.when(F.col("role") == r, path)).alias(f"{r}_path")
                for r in paths.ROLES
            ]
        )
    )


def is_complete() -> Column:
    """Invoice and declaration are present; the royalty agreement is optional."""
    return F.col("invoice_path").isNotNull() & F.col("declaration_path").isNotNull()


def complete_cases(inventory: DataFrame) -> DataFrame:
    return inventory.where(is_complete())


def rejected_cases(inventory: DataFrame) -> DataFrame:
    """Cases to look at again on the next run."""
    return inventory.where(~is_complete())


def completeness(cases: DataFrame) -> DataFrame:
    """How many cases have which combination of documents."""
    flags = [F.col(c).isNotNull().alias("has_" + c[: -len("_path")]) for c in PATH_COLUMNS]
    return cases.groupBy(*flags).count().orderBy(F.desc("count"))


def translated_run(parsed: DataFrame, run: int | None = None) -> DataFrame:
    """Translated documents, of one run if given (prunes the run partitions)."""
    ready = parsed.where(F.col("parsed_content_translated").isNotNull())
    return ready if run is None else ready.where(F.col("processed") == run)


def pending_documents(parsed: DataFrame, run: int) -> DataFrame:
    """Documents of the run still to translate, and those without a run."""
    this_run = (F.col("processed") == run) | F.col("processed").isNull()
    return parsed.where(this_run & F.col("parsed_content_translated").isNull())


# What documents come with: their JSON, or the elements that were read from it before.
JSON, ELEMENTS = "parsed_content_translated", "elements"
# How many elements of a document cannot be read, -1 if it cannot itself.
BAD = "bad_elements"


def _elements_in(content: str) -> Column:
    return F.col(content) if content == ELEMENTS else document_elements(F.col(content))


@built_once
def _metadata_column(path: str, content: str) -> Column:
    return structured_metadata(F.col(path), _elements_in(content))


def document_fields(parsed: DataFrame, content: str = JSON) -> DataFrame:
    """One row per document: case_id, path, the ten fields, bad_amounts."""
    return parsed.select(
        paths.case_id(F.col("path")).alias("case_id"),
        "path",
        _metadata_column("path", content).alias("fields"),
    ).select("case_id", "path", "fields.*")


def case_rollup(parsed: DataFrame, content: str = JSON) -> DataFrame:
    """The ten fields per case.

    The first non-null value in path order, so the answer does not depend on
    the order of the input.  The minimum combines on the map side: a case with
    very many documents sends one partial row per task.
    """

    def first_value(name: str) -> Column:
        found = F.when(F.col(name).isNotNull(), F.struct("path", F.col(name).alias("v")))
        return F.min(found)["v"].alias(name)

    return document_fields(parsed, content).groupBy("case_id").agg(*map(first_value, FIELD_TYPES))


def unreadable_amounts(parsed: DataFrame) -> DataFrame:
    """Quarantine: declared amounts that could not be read as numbers."""
    return (
        document_fields(parsed)
        .where(F.size("bad_amounts") > 0)
        .select("case_id", "path", "bad_amounts")
    )


def unreadable_documents(parsed: DataFrame) -> DataFrame:
    """Quarantine: translated documents that are not JSON or have unreadable elements.

    ``bad_elements`` counts the latter; it is NULL if nothing could be read.
    """
    text = F.col("parsed_content_translated")
    return listed_unreadable(parsed.where(text.isNotNull()).select("path", unreadable_elements(text).alias(BAD)))


def listed_unreadable(counted: DataFrame) -> DataFrame:
    """The quarantine from documents with the count of their unreadable elements."""
    n = F.col(BAD)
    return counted.where(n != 0).select("path", F.when(n > 0, n).alias(BAD))


def document_chunks(parsed: DataFrame) -> DataFrame:
    """One row per content element with cleaned text and a global chunk id."""
    path = F.col("path")
    return parsed.select(
        paths.case_id(path).alias("case_id"),
        paths.document_id(path).alias("document_id"),
        path.alias("document_path"),
        "source_language",
        "translation_applied",
        F.explode(content_chunks(document_elements(F.col("parsed_content_translated")))).alias(
            "chunk"
        ),
    ).select(
        "case_id",
        "document_id",
        "document_path",
        "source_language",
        "translation_applied",
        F.col("chunk.chunk_id").alias("chunk_id"),
        clean_text(F.col("chunk.content")).alias("text"),
        F.concat_ws("_", "case_id", "document_id", "chunk.chunk_id").alias("id"),
    )


def enriched_chunks(parsed: DataFrame, cases: DataFrame, content: str = JSON) -> DataFrame:
    """The chunk table: chunks with the fields and paths of their case.

    ``content`` names the column of the documents, their JSON or, as
    ``elements``, what was read from it before.

    The two case-level sides are joined to each other first, and the documents
    meet them *before* the chunks are exploded, so one shuffle moves documents
    and none moves chunk rows.  Both case sides hold one row per case; a case
    with a large share of the documents is split by the adaptive skew join.
    """
    case_side = case_rollup(parsed, content).join(
        cases.select(F.col("id").alias("case_id"), *PATH_COLUMNS), "case_id", "left"
    )
    path = F.col("path")
    documents = parsed.select(
        paths.case_id(path).alias("case_id"),
        "path",
        content,
        "source_language",
        "translation_applied",
    )
    joined = documents.join(case_side, "case_id", "left")
    fields = list(FIELD_TYPES)
    return joined.select(
        "case_id",
        paths.document_id(path).alias("document_id"),
        path.alias("document_path"),
        "source_language",
        "translation_applied",
        F.explode(content_chunks(_elements_in(content))).alias("chunk"),
        *fields,
        *PATH_COLUMNS,
    ).select(
        "case_id",
        "document_id",
        "document_path",
        "source_language",
        "translation_applied",
        F.col("chunk.chunk_id").alias("chunk_id"),
        clean_text(F.col("chunk.content")).alias("text"),
        F.concat_ws("_", "case_id", "document_id", "chunk.chunk_id").alias("id"),
        *fields,
        *PATH_COLUMNS,
        F.concat_ws(" | ", *PATH_COLUMNS).alias("metadata"),
    )
