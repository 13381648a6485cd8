"""File listings, binary reads and line sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.functions import paths
from casewright.functions.text import strip


def list_files(spark: SparkSession, root: str, pattern: str = "*", since: str | None = None) -> DataFrame:
    """path, modificationTime and length of files below ``root``.

    The content column is not selected, so no file is opened.  ``since`` is
    exclusive.
    """
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
    )
    if since is not None:
        reader = reader.option("modifiedAfter", since)
    return reader.load(root).select("path", "modificationTime", "length")


def list_case_files(
    spark: SparkSession,
    root: str,
    since: str | None = None,
    until: str | None = None,
    pattern: str = "*.[pP][dD][fF]",
) -> DataFrame:
    """Files of case folders, by default PDFs, with ``since < modified <= until``."""
    files = list_files(spark, root, pattern, since)
    if until is not None:
        files = files.where(F.col("modificationTime") <= F.lit(until).cast("timestamp"))
    return files.where(paths.case_folder(F.col("path")).isNotNull())


def read_binary(spark: SparkSession, roots: str | list[str], pattern: str = "*") -> DataFrame:
    """path and content of all files, as one read whatever the number of paths."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(roots)
        .select("path", "content")
    )


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """One ``question`` per non-blank line."""
    return (
        spark.read.text(path)
        .select(strip(F.col("value")).alias("question"))
        .where(F.col("question") != "")
    )
