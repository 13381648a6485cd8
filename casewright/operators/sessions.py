"""Conversation memory: stored messages, ordered reads, prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.operators.ranking import position_in_group

BUCKETS = 64


def message_json(role: Column, content: Column) -> Column:
    return F.to_json(F.struct(role.alias("role"), content.alias("content")))


def append_messages(messages: DataFrame, path: str) -> None:
    """Append id, session_id, message_data and created_at.

    Files are laid out by a hash of the session, which serves as the index: a
    read of one session opens one bucket.
    """
    bucket = F.pmod(F.xxhash64("session_id"), F.lit(BUCKETS)).cast("int")
    messages.withColumn("bucket", bucket).write.mode("append").partitionBy("bucket").parquet(path)


def read_session(spark: SparkSession, path: str, session_id: str) -> DataFrame:
    """Messages of one session in the order they were saved."""
    # The bucket is computed from a literal, so only its folder is listed.
    bucket = F.pmod(F.xxhash64(F.lit(session_id)), F.lit(BUCKETS)).cast("int")
    return (
        spark.read.parquet(path)
        .where((F.col("bucket") == bucket) & (F.col("session_id") == session_id))
        .orderBy("created_at", "id")
        .select("message_data")
    )


def session_history(messages: DataFrame) -> DataFrame:
    """All sessions as rows with a 1-based ``seq`` in saving order.

    Rows rather than one array per session: a session may be of any length.
    """
    return position_in_group(messages, "session_id", "created_at_ms", "id", "seq")


def last_message(messages: DataFrame, group: str = "conv_id", order: str = "turn") -> DataFrame:
    """The newest message of each conversation; combines before the shuffle."""
    rest = [c for c in messages.columns if c not in (group, order)]
    newest = F.max_by(F.struct(*rest), order)
    return messages.groupBy(group).agg(
        F.max(order).alias(order), newest.alias("_m")
    ).select(group, order, *[F.col(f"_m.{c}").alias(c) for c in rest])


def conversation_prompt(
    history: DataFrame, system_prompt: str, inputs: DataFrame | None = None
) -> DataFrame:
    """Prompt messages as rows: system first, then the history, then the input.

    ``history`` has conv_id, turn, role and text; ``inputs`` has conv_id and
    text of the new user message.  ``ordinal`` counts from 0 per conversation.
    """
    numbered = position_in_group(history, "conv_id", "turn", name="ordinal").select(
        "conv_id", "ordinal", "role", F.col("text").alias("content")
    )
    sizes = history.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    system = sizes.select(
        "conv_id",
        F.lit(0).cast("long").alias("ordinal"),
        F.lit("system").alias("role"),
        F.lit(system_prompt).alias("content"),
    )
    out = numbered.unionByName(system)
    if inputs is not None:
        new = inputs.join(sizes, "conv_id", "left").select(
            "conv_id",
            (F.coalesce("n", F.lit(0)) + 1).alias("ordinal"),
            F.lit("user").alias("role"),
            F.col("text").alias("content"),
        )
        out = out.unionByName(new)
        first_time = inputs.join(sizes, "conv_id", "left_anti").select(
            "conv_id",
            F.lit(0).cast("long").alias("ordinal"),
            F.lit("system").alias("role"),
            F.lit(system_prompt).alias("content"),
        )
        out = out.unionByName(first_time)
    return out


def final_messages(events: DataFrame) -> DataFrame:
    """Items of finished message events.

    ``events`` has ``type`` and ``item`` (a struct with ``type``).
    """
    return events.where(
        (F.col("type") == "response.output_item.done") & (F.col("item.type") == "message")
    ).select("*", "item.*").drop("item", "type")
