"""Trace and request-log analysis, and usage costs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casewright.functions.numeric import token_cost

# Published price list, units per million tokens.
TOKEN_PRICES = (
    ("Llama 4 Maverick", 7.143, 21.429),
    ("Llama 3.3 70B", 7.143, 21.429),
    ("GPT OSS 120B", 2.143, 8.571),
    ("Gemma 3 12B", 2.143, 7.143),
    ("Llama 3.1 8B", 2.143, 6.429),
    ("GPT OSS 20B", 1.000, 4.286),
)
# Units per hour of reserved capacity (entry, scaling).
HOURLY_PRICES = (
    ("Llama 4 Maverick", 85.714, 85.714),
    ("Llama 3.3 70B", 85.714, 342.857),
    ("Llama 3.1 8B", 53.571, 106.000),
    ("Llama 3.2 3B", 46.429, 92.857),
    ("Llama 3.2 1B", 42.857, 85.714),
)


def token_prices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        TOKEN_PRICES, "model string, in_rate double, out_rate double"
    )


def hourly_prices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        HOURLY_PRICES, "model string, entry_rate double, scaling_rate double"
    )


def traces_from_events(events: DataFrame) -> DataFrame:
    """The trace log of an event stream (one trace per event)."""
    id_ = F.col("event_id").cast("string")
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        id_.alias("request_id"),
        F.concat(F.lit("tr-"), id_).alias("trace_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"),
        F.round(F.col("value") * 100).cast("long").alias("execution_time_ms"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("OK").alias("status"),
        F.create_map(
            F.lit("kind"), F.col("event_type"), F.lit("k"), k.cast("string")
        ).alias("tags"),
        F.create_map(
            F.lit("session"), F.concat(F.lit("user-"), F.col("user_id").cast("string"))
        ).alias("request_metadata"),
        F.when(
            k % 4 > 0,
            F.transform(
                F.sequence(F.lit(1), F.greatest(k % 4, F.lit(1))),
                lambda i: F.struct(F.concat(F.lit("span-"), i.cast("string")).alias("name")),
            ),
        ).alias("spans"),
    )


def search_traces(
    traces: DataFrame,
    tags: dict[str, str] | None = None,
    metadata: dict[str, str] | None = None,
    status: str | None = None,
    since_ms: int | None = None,
    until_ms: int | None = None,
) -> DataFrame:
    """Traces that meet every given condition; order and limit at the consumer."""
    conditions: list[Column] = []
    conditions += [F.col("tags")[k] == v for k, v in (tags or {}).items()]
    conditions += [F.col("request_metadata")[k] == v for k, v in (metadata or {}).items()]
    if status is not None:
        conditions.append(F.col("status") == status)
    if since_ms is not None:
        conditions.append(F.col("timestamp_ms") >= since_ms)
    if until_ms is not None:
        conditions.append(F.col("timestamp_ms") < until_ms)
    return traces.where(reduce(lambda a, b: a & b, conditions)) if conditions else traces


def latest(df: DataFrame, n: int, time: str = "timestamp_ms", tie: str = "trace_id") -> DataFrame:
    """The newest ``n`` rows; the plan keeps ``n`` rows per task, no full sort."""
    return df.orderBy(F.desc(time), tie).limit(n)


def scalar_columns(df: DataFrame) -> DataFrame:
    """The columns of simple types: no arrays, maps, structs or variants."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    return df.select(*[f.name for f in df.schema if not isinstance(f.dataType, nested)])


def duration_stats(traces: DataFrame) -> DataFrame:
    d = F.col("execution_time_ms")
    return traces.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(d).alias("avg_ms"),
        F.min(d).alias("min_ms"),
        F.max(d).alias("max_ms"),
        F.sum(span_count()).alias("spans"),
    )


def span_count() -> Column:
    return F.coalesce(F.array_size("spans"), F.lit(0))


def status_counts(traces: DataFrame) -> DataFrame:
    return traces.groupBy("status").count().orderBy(F.desc("count"), "status")


def usage_cost(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Cost per model of a usage log with model, tokens_in and tokens_out.

    The log is summed per model first; the price list meets a handful of rows.
    """
    totals = usage.groupBy("model").agg(
        F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out")
    )
    return totals.join(prices, "model", "left").select(
        "model",
        "tokens_in",
        "tokens_out",
        token_cost(
            F.col("tokens_in"), F.col("tokens_out"), F.col("in_rate"), F.col("out_rate")
        ).alias("cost"),
    )


def windowed_activity(
    events: DataFrame, time: str = "ts", width: str = "1 hour", more: tuple[Column, ...] = ()
) -> DataFrame:
    """Requests, errors and latency per time window, and any aggregates given in ``more``."""
    failed = F.col("event_type") == "error"
    return (
        events.groupBy(F.window(time, width).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(failed).alias("errors"),
            # cents as longs: the sum does not depend on the order of the rows
            F.sum(F.round(F.col("value") * 100).cast("long")).alias("latency_sum"),
            F.max("value").alias("latency_max"),
            *more,
        )
        .withColumn("start", F.col("w.start"))
        .drop("w")
    )
