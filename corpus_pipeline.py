"""A training-data pipeline over ``documents``, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casewright.llm import decontamination, packing, pii, repetition, simhash
from casewright.session import shared_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are too short, or repeat too much of themselves.

    A null or empty text is too short; equal rows have equal fates; an empty
    table gives no rows.
    """
    return repetition.keep_judged(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of every group of near-duplicates.

    Texts without words are near to each other; of repeated rows one stays; an
    empty table gives no rows.
    """
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of a test item.

    Null and empty texts hold none; equal rows have equal fates; an empty
    table on either side drops nothing.
    """
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; no document is dropped.

    Null and empty texts stay as they are; equal rows give equal rows; an
    empty table gives no rows.
    """
    return pii.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of fixed windows over the ids of all remaining documents.

    A null or empty text is its end id alone; equal rows are packed one by
    one; an empty table gives no pieces.
    """
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mask_private", mask_private),
    ("packing", pack),
]

# Prefix sums over token ids and 64-bit hashes have no DuckDB form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each stored before the next begins."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        folder = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
