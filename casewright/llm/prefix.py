"""Global prefix sums in two passes: totals per partition, then running sums inside each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "_part"


def partition_bases(table: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """For every partition number the totals of all smaller ones, as ``<name>_base``.

    One row per partition of the table: that is what the single-task window
    sees and what a join may broadcast, however many rows the table has.
    """
    totals = table.groupBy(PART).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        PART, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_base") for n in sums]
    )


def ordered_offsets(
    df: DataFrame, order: list[str], sums: dict[str, Column], folder: str
) -> DataFrame:
    """Add to every row the sums over all rows before it in the order of ``order``.

    The rows are dealt out by ranges of the order columns and stored, so that
    partition numbers stay what they are when an executor is lost.  Rows equal
    in all order columns follow each other in any order.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    spread.withColumn(PART, F.spark_partition_id()).write.parquet(folder)
    table = df.sparkSession.read.parquet(folder)
    bases = partition_bases(table, sums)
    before = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = table.select(
        "*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{n}_in") for n, c in sums.items()]
    )
    joined = inside.join(F.broadcast(bases), PART)
    return joined.select(
        *df.columns, *[(F.col(f"{n}_base") + F.col(f"{n}_in")).alias(f"{n}_before") for n in sums]
    )
