"""Registered queries of the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.llm import (
    bpe,
    decontamination,
    html_text,
    licenses,
    negatives,
    packing,
    pii,
    repetition,
    sharding,
    simhash,
    spelling,
    substring,
    token_files,
)
from casewright.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_substring_dedup(spark, d):
    documents = _table(spark, d, "documents")
    kept = substring.kept_texts(substring.unique_texts(documents))
    digest = kept.select("text_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    return substring.of_documents(documents, digest).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


@query
def op2_pii(spark, d):
    found = pii.find_private(_table(spark, d, "documents"))
    base = F.filter("spans", lambda s: s.base)

    def count(kind):
        return F.size(F.filter(base, lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in pii.BASE_KINDS],
        F.sha2(pii.joined(base), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


@query
def op3_html_text(spark, d):
    return html_text.extract(_table(spark, d, "pages"))


@query
def op4_token_files(spark, d):
    folder = shared_folder(spark, "token-files")
    token_files.write_tokens(_table(spark, d, "documents"), folder)
    return token_files.read_tokens(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query
def op5_decontamination(spark, d):
    return decontamination.contaminated_passages(
        _table(spark, d, "documents"), _table(spark, d, "benchmark")
    ).groupBy("doc_id", "item_id").agg(
        F.round(F.max("score"), 6).alias("score"), F.count("*").alias("passages")
    )


@query
def op6_packing(spark, d):
    return packing.pack(_table(spark, d, "documents"))


@query
def op7_simhash(spark, d):
    return simhash.near_duplicates(_table(spark, d, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op8_sharding(spark, d):
    return sharding.balanced_shards(_table(spark, d, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_license_scan(spark, d):
    found = licenses.scan_licences(_table(spark, d, "documents"))
    return found.select(
        "doc_id", "scope", "first_line", "last_line", "licence", F.round("dice", 6).alias("dice")
    )


@query
def op10_quality_rules(spark, d):
    return repetition.judged(_table(spark, d, "documents")).drop("longest_repeat")


@query
def op11_spelling_variants(spark, d):
    words = spelling.stored_words(spelling.observed_words(_table(spark, d, "documents")))
    return spelling.spelling_variants(words)


@query
def op12_hard_negatives(spark, d):
    vectors = _table(spark, d, "embeddings")
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.stored_rows(negatives.scaled_rows(vectors.withColumn("label", other)))
    found = negatives.hard_negatives(rows, rows.where(F.col("vec_id") % 100 == 0))
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@query
def op13_pair_index_bpe(spark, d):
    texts = bpe.decode_ids(bpe.encode_texts(_table(spark, d, "documents")))
    return texts.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
