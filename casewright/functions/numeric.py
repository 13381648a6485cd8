"""Arithmetic, the calculator and the cost formulas."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def calculator(operation: Column, a: Column, b: Column) -> Column:
    """add, subtract, multiply, divide; a zero divisor gives infinity.

    An unknown operation fails the query.
    """
    return (
        F.when(operation == "add", a + b)
        .when(operation == "subtract", a - b)
        .when(operation == "multiply", a * b)
        .when(
            operation == "divide",
            F.when(b == 0, F.lit(float("inf"))).otherwise(F.try_divide(a, b)),
        )
        .otherwise(
            F.raise_error(F.concat(F.lit("Unknown operation: "), operation)).cast("double")
        )
    )


def token_cost(tokens_in: Column, tokens_out: Column, in_rate: Column, out_rate: Column) -> Column:
    """Pay-per-token cost; rates are units per million tokens."""
    return tokens_in / F.lit(1_000_000) * in_rate + tokens_out / F.lit(1_000_000) * out_rate


# Fixed value: tokens per second that one model unit serves.
TOKENS_PER_SECOND = 65


def reserved_cost(units: Column, hours: Column, unit_hour_rate: Column) -> Column:
    """struct<total_cost,total_tokens,cost_per_million> of reserved capacity."""
    cost = units * hours * unit_hour_rate
    served = units.cast("long") * TOKENS_PER_SECOND * 3600 * hours
    return F.struct(
        cost.cast("double").alias("total_cost"),
        served.alias("total_tokens"),
        (F.try_divide(cost, served) * 1_000_000).cast("double").alias("cost_per_million"),
    )


def cost_difference(token: Column, reserved: Column) -> Column:
    """Pay-per-token cost minus reserved cost; negative while paying per token is cheaper."""
    return token - reserved


SQL_FUNCTIONS = {
    "add_numbers": "a + b",
    "subtract_numbers": "a - b",
    "multiply_numbers": "a * b",
    "divide_numbers": "try_divide(a, b)",
}


def register_arithmetic(spark: SparkSession) -> None:
    """Register the four arithmetic SQL functions for this session."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(a DOUBLE, b DOUBLE) "
            f"RETURNS DOUBLE RETURN {body}"
        )
