"""Top-k and positions that hold up when one group is very large."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.session import shared_folder


def top_k(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows per group with their ``rank``.

    The bound on row_number() becomes a group limit before the shuffle, so a
    large group sends at most ``k`` rows per task.
    """
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def position_in_group(
    df: DataFrame, group: str, order: str, tie: str | None = None, name: str = "position"
) -> DataFrame:
    """1-based position by ``order``, then ``tie``, within ``group``.

    A plain row_number() would sort a whole group in one task.  Here the rows
    are dealt out by ranges of group, order and tie and stored, so a huge
    group, or one value of ``order`` on all of its rows, lies in as many
    partitions as its size asks for.  A first pass counts the rows of each
    group in each partition; a second numbers them inside, and adds the counts
    of the earlier partitions.
    """
    spark = df.sparkSession
    keys = [c for c in (group, order, tie) if c]
    folder = shared_folder(spark, "positions")
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = ranged.withColumn("_part", F.spark_partition_id())
    placed.write.parquet(folder)
    rows = spark.read.schema(placed.schema).parquet(folder)
    counts = rows.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of a group, so that many at most in one window.
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(group).alias("_group"), F.col("_part").alias("_at"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy(group, "_part").orderBy(*keys[1:])
    mine = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_at"))
    return (
        rows.withColumn("_row", F.row_number().over(within))
        .join(offsets, mine)
        .withColumn(name, F.col("_before") + F.col("_row"))
        .drop("_part", "_row", "_before", "_group", "_at")
    )

