"""Snapshot merges for plain Parquet tables.

Parquet has no MERGE statement, so each function takes the current snapshot
and the changes and returns the next snapshot; a writer puts that into a new
version.  As with MERGE, a key that occurs twice in the source is an error.
The target is only the left side of joins with the source: a source small
enough to be broadcast moves no row of the target.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(key: str | Iterable[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _unique_source(source: DataFrame, keys: list[str]) -> DataFrame:
    """The source; reading it fails on a key that occurs twice."""
    message = F.concat(
        F.lit("more than one source row for key "),
        F.to_json(F.struct(*[F.col(k) for k in keys])),
    )
    counted = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(message)).alias("_one"),
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    checked = source.join(counted, same).where("_one")
    return checked.select(*source.columns)


def _update(target: DataFrame, source: DataFrame, keys: list[str], columns: Iterable[str]) -> DataFrame:
    names = [c for c in columns if c in source.columns and c in target.columns and c not in keys]
    row = F.struct(*[F.col(c) for c in names], F.lit(True).alias("_hit")).alias("_s")
    joined = target.join(source.select(*keys, row), keys, "left")

    def value(name: str) -> Column:
        if name not in names:
            return F.col(name)
        return F.when(F.col("_s").isNotNull(), F.col("_s")[name]).otherwise(F.col(name)).alias(name)

    return joined.select(*[value(c) for c in target.columns])


def _missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks, in the target's columns.

    The target is reduced to the keys it shares with the source before the
    source is compared with it.
    """
    shared = target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()
    new = source.join(shared, keys, "left_anti")
    kinds = dict(target.dtypes)
    return new.select(
        *[
            (F.col(c) if c in source.columns else F.lit(None)).cast(kinds[c]).alias(c)
            for c in target.columns
        ]
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str | Iterable[str],
    update_columns: Iterable[str] = ("processed", "volume_path"),
) -> DataFrame:
    """Update ``update_columns`` of matched rows, insert unmatched source rows.

    Columns outside ``update_columns`` keep the target's values on a match.
    """
    keys = _keys(key)
    rows = _unique_source(source, keys)
    return _update(target, rows, keys, update_columns).unionByName(_missing(target, rows, keys))


def insert_only(target: DataFrame, source: DataFrame, key: str | Iterable[str]) -> DataFrame:
    """Insert unmatched source rows; existing rows never change."""
    keys = _keys(key)
    return target.unionByName(_missing(target, _unique_source(source, keys), keys))


def update_only(
    target: DataFrame,
    source: DataFrame,
    key: str | Iterable[str],
    update_columns: Iterable[str],
) -> DataFrame:
    """Update matched rows; source rows without a match are ignored."""
    keys = _keys(key)
    return _update(target, _unique_source(source, keys), keys, update_columns)


def changed_rows(
    current: DataFrame, indexed: DataFrame, key: str = "id", text: str = "text"
) -> DataFrame:
    """Rows of ``current`` that the index lacks or holds with another text.

    ``indexed`` holds the key and ``text_hash``, see :func:`text_hash`.
    """
    return (
        current.withColumn("text_hash", text_hash(F.col(text)))
        .join(indexed.select(key, "text_hash"), [key, "text_hash"], "left_anti")
    )


def text_hash(text: Column) -> Column:
    return F.xxhash64(text)
