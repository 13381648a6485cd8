"""Run-partitioned Parquet tables and schema evolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = "processed"


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Give a table read as a few large splits to all cores.

    A single row group cannot be split by the reader, and work that is heavy
    per row would run on one core.  A table with at least as many splits as
    there are cores comes back as it is, so a large one is never shuffled.
    ``scan`` must be a plain table read: counting its splits plans but runs
    nothing.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, key)


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the missing columns as NULLs; names compare without case."""
    present = {c.lower() for c in df.columns}
    missing = {
        name: F.lit(None).cast(kind)
        for name, kind in columns.items()
        if name.lower() not in present
    }
    return df.withColumns(missing) if missing else df


def create_if_absent(df: DataFrame, path: str) -> None:
    """Write only if nothing is there yet."""
    df.write.mode("ignore").parquet(path)


def append_evolving(df: DataFrame, path: str, run: str = RUN) -> None:
    """Append rows, possibly with new columns, below one folder per run."""
    df.write.mode("append").partitionBy(run).parquet(path)


def overwrite_runs(df: DataFrame, path: str, run: str = RUN) -> None:
    """Replace the runs present in ``df`` and keep all others.

    Writing a run twice leaves one copy, unlike an append.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(run)
        .parquet(path)
    )


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Union of all column sets; columns a file lacks read as NULL."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def latest_run(df: DataFrame, run: str = RUN) -> DataFrame:
    """One row with the newest run."""
    return df.agg(F.max(run).alias("latest_run"))


def run_slice(df: DataFrame, run: int | Column) -> DataFrame:
    """Rows of one run; prunes to one folder on a run-partitioned table."""
    return df.where(F.col(RUN) == run)


def run_time(run: Column) -> Column:
    """Timestamp of a yyyyMMddHHmm run number."""
    return F.to_timestamp(run.cast("string"), "yyyyMMddHHmm")


def watermark_start(df: DataFrame, now: Column | None = None, fallback_days: int = 5) -> DataFrame:
    """One row with the start of the next incremental interval.

    The newest run, or ``fallback_days`` before ``now`` when there is none.
    """
    now = F.current_timestamp() if now is None else now
    fallback = now - F.make_dt_interval(F.lit(fallback_days))
    return df.agg(F.coalesce(run_time(F.max(RUN)), fallback).alias("range_start"))
