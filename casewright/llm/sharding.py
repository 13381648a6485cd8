"""Contiguous shards of nearly equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.prefix import ordered_offsets
from casewright.session import shared_folder

SHARDS = 40
ROW_BYTES = 16
# A group of copies stays whole up to this fraction of a shard.
WHOLE_FRACTION = 100


def balanced_shards(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document.

    The size is the UTF-8 length of the text plus ``ROW_BYTES``.  Documents
    are ordered by the smallest id among their copies (equal texts), then by
    their own id, which makes copies neighbours.  Global prefix sums give each
    its byte offset, and equal targets cut the order into shards: the shard is
    the one its middle byte falls into.  A group of copies of at most a
    hundredth of a shard is placed as one; a larger one is cut like any run of
    documents, so sizes differ by little more than that or one document.

    Only DataFrame functions are used.  Texts are not shuffled; what is has
    a few numbers per document.
    A null text counts as empty, null ids come first, equal rows are kept
    apart by their slots, an empty table gives no rows, and other columns of
    the input are not looked at.
    """
    spark = documents.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.col("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("copy"),
    )
    same = ["copy", "size", "text_crc32"]
    groups = rows.groupBy(*same).agg(
        F.min("doc_id").alias("leader"), F.count("*").alias("members")
    )
    folder = shared_folder(spark, "shard-groups")
    placed = ordered_offsets(
        groups,
        ["leader", *same],
        {"bytes": F.col("size") * F.col("members"), "rows": F.col("members")},
        folder,
    )
    members = rows.join(placed, same).select(
        "doc_id", "size", "text_crc32", "members", "bytes_before", "rows_before"
    )
    ranked = ordered_offsets(
        members.withColumnsRenamed({"bytes_before": "group_byte", "rows_before": "group_row"}),
        ["group_row", "doc_id"],
        {"rows": F.lit(1)},
        shared_folder(spark, "shard-rows"),
    )
    stored = spark.read.parquet(folder)
    total = stored.agg(F.sum(F.col("size") * F.col("members"))).first()[0] or 1
    rank = F.col("rows_before") - F.col("group_row")
    whole = F.col("size") * F.col("members") * (shards * WHOLE_FRACTION) <= total
    middle = F.when(
        whole, 2 * F.col("group_byte") + F.col("size") * F.col("members")
    ).otherwise(2 * (F.col("group_byte") + rank * F.col("size")) + F.col("size"))
    sharded = ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        "rows_before",
        F.least(F.lit(shards - 1), F.floor(middle * shards / (2 * total)))
        .cast("int")
        .alias("shard"),
    )
    first = sharded.groupBy("shard").agg(F.min("rows_before").alias("first"))
    return sharded.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("rows_before") - F.col("first")).alias("slot")
    )
