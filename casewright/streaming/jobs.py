"""Structured Streaming jobs.

Each job processes what is there and stops (``availableNow``); a schedule runs
it again and the checkpoint remembers what was done.  A batch is written to a
folder named after the stream and the batch number, replacing what a failed
attempt left, so a retry neither loses nor repeats rows.  The stream's name is
the id its checkpoint keeps: a new checkpoint over a stored table numbers its
batches from 0 again, but writes beside the old ones.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from casewright.functions.html import page_elements
from casewright.functions.text import built_once
from casewright.operators.logs import windowed_activity
from casewright.operators.merge import text_hash
from casewright.operators.sessions import BUCKETS
from casewright.sources.tables import spread

STREAM = "stream"
BATCH = "batch"
VERSION = "version"
# So many ids at most are broadcast; above, rows and ids meet in a shuffle.
FEW_IDS = 2_000_000


class Step(NamedTuple):
    """One micro-batch of one stream."""

    stream: str
    batch: int

    def mine(self) -> Column:
        return (F.col(STREAM) == self.stream) & (F.col(BATCH) == self.batch)


# Current keys and hashes, without what a step wrote itself.
Known = Callable[[SparkSession, Step], "DataFrame | None"]


def read_stream(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet") -> DataFrame:
    """Parquet files of a folder as a stream."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    )


def read_table_stream(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """A table of a folder, one Parquet file or a folder of them, as a stream.

    A pattern with one alternative stands for either; a plain path would have to be a folder.
    """
    return spark.readStream.schema(schema).parquet(f"{folder}/{{{name}.parquet}}")


def write_batch(df: DataFrame, step: Step, path: str, by: tuple[str, ...] = ()) -> None:
    """Write one micro-batch as its own folder, replacing an earlier attempt."""
    (
        df.withColumns({STREAM: F.lit(step.stream), BATCH: F.lit(step.batch)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*by, STREAM, BATCH)
        .parquet(path)
    )


def stored_rows(
    spark: SparkSession, path: str, before: Step | None = None, schema: StructType | None = None
) -> DataFrame | None:
    """All rows written so far, without those of a step; None while there are none.

    Their columns are looked up in the files unless a schema is given.
    """
    try:
        rows = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return rows if before is None else rows.where(~before.mine())


def run_available(
    stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, Step], None], mode: str = "append"
) -> StreamingQuery:
    """Process all available input through ``sink`` and wait for the end."""
    started = threading.Event()
    name: list[str] = []

    def step(df: DataFrame, batch_id: int) -> None:
        started.wait()
        sink(df, Step(name[0], batch_id))

    query = (
        stream.writeStream.foreachBatch(step)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    name.append(str(query.id))
    started.set()
    query.awaitTermination()
    return query


def append_sessions(messages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append session messages once each, however late they come.

    A message is known by (session_id, id).  A batch is compared with the
    stored keys of its sessions' buckets, so nothing has to be remembered in
    between and no message is too old.
    """

    def sink(df: DataFrame, step: Step) -> None:
        bucket = F.pmod(F.xxhash64("session_id"), F.lit(BUCKETS)).cast("int")
        new = df.dropDuplicates(["session_id", "id"]).withColumn("bucket", bucket)
        stored = stored_rows(df.sparkSession, path, step)
        if stored is not None:
            touched = [r.bucket for r in df.select(bucket.alias("bucket")).distinct().collect()]
            keys = stored.where(F.col("bucket").isin(touched)).select("bucket", "session_id", "id")
            new = new.join(keys, ["bucket", "session_id", "id"], "left_anti")
        write_batch(new, step, path, ("bucket",))

    return run_available(messages, checkpoint, sink)


def extract_pages(pages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Incremental document extraction: the batch expressions on a stream."""
    rows = explode_page_elements(pages)
    return run_available(rows, checkpoint, lambda df, step: write_batch(df, step, path))


@built_once
def _page_elements(html: str) -> Column:
    return page_elements(F.col(html))


def explode_page_elements(pages: DataFrame) -> DataFrame:
    """page_id, idx, type and content of every element of raw HTML pages."""
    return pages.select("page_id", F.inline(_page_elements("html"))).select(
        "page_id", F.col("id").cast("int").alias("idx"), "type", "content"
    )


def _few(ids: DataFrame) -> tuple[DataFrame, int]:
    """Different ids as ``_id``, to be broadcast if they are few, and their number (or one more than few)."""
    n = ids.limit(FEW_IDS + 1).count()
    named = ids.select(F.col("id").alias("_id"))
    return (F.broadcast(named) if n <= FEW_IDS else named), n


def without_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is not among different ids; rows without an id stay."""
    named, n = _few(ids)
    return rows.join(named, F.col("id") == F.col("_id"), "left_anti") if n else rows


def _greatest_per_id(rows: DataFrame, values: list[str], place: Column) -> DataFrame:
    """One row per id, the greatest by ``place``; only rows of ids that come repeatedly are moved.

    A missing id is an id like any other.
    """
    repeated = rows.groupBy("id").count().where(F.col("count") > 1).select("id")
    named, n = _few(repeated)
    if not n:
        return rows.select("id", *values)
    same = F.col("id").eqNullSafe(F.col("_id"))
    several = rows.join(named, same, "left_semi").groupBy("id").agg(F.max_by(F.struct(*values), place).alias("_v"))
    return rows.join(named, same, "left_anti").select("id", *values).unionByName(several.select("id", "_v.*"))


def newest_per_id(rows: DataFrame, order: str | None) -> DataFrame:
    """One row per id: the greatest in ``order``, of equals that of the greatest text hash."""
    place = F.struct(*[F.col(c) for c in ([order] if order else [])], "text_hash")
    return _greatest_per_id(rows, [c for c in rows.columns if c != "id"], place)


def sync_index(
    chunks: DataFrame,
    path: str,
    checkpoint: str,
    embed: Callable[[DataFrame], DataFrame],
    order: str | None = None,
    known: Known | None = None,
) -> StreamingQuery:
    """Embed new and changed chunks of a stream only, see :func:`index_batch`.

    A batch of a few large splits is spread: embedding moves no rows by itself.
    """
    return run_available(
        chunks, checkpoint, lambda df, step: index_batch(spread(df, "id"), step, path, embed, order, known)
    )


def index_batch(
    df: DataFrame,
    step: Step,
    path: str,
    embed: Callable[[DataFrame], DataFrame],
    order: str | None = None,
    known: Known | None = None,
) -> None:
    """Write the chunks (id, text) that are new or changed as one step of the index.

    Of several versions of an id the last in the column ``order`` counts.
    Only key, text hash and version of the stored rows are read, and only for
    the ids at hand; ``known`` may give current keys and hashes from
    elsewhere.  What an earlier attempt of the same step wrote is replaced and
    does not count as stored.  A row with a higher version replaces the older
    ones of its id, see :func:`current_index`.
    """
    spark = df.sparkSession
    latest = newest_per_id(df.withColumn("text_hash", text_hash(F.col("text"))), order)
    stored = stored_rows(spark, path, step)
    if stored is not None:
        current = known(spark, step) if known else None
        if current is None:
            mine = stored.select("id", "text_hash", VERSION).join(
                df.select("id").distinct(), "id", "left_semi"
            )
            current = newest_versions(mine)
        # Keys and hashes meet, and the texts of the new and changed are looked up by id.
        keys = latest.select("id", "text_hash")
        changed, n = _few(keys.join(current.select("id", "text_hash"), ["id", "text_hash"], "left_anti"))
        same = F.col("id").eqNullSafe(F.col("_id"))
        latest = latest.join(changed, same, "left_semi") if n else latest.limit(0)
    write_batch(embed(latest).withColumn(VERSION, F.lit(next_version(stored)).cast("long")), step, path)


def next_version(stored: DataFrame | None) -> int:
    """The version of the next step."""
    last = None if stored is None else stored.agg(F.max(VERSION)).first()[0]
    return 0 if last is None else last + 1


def newest_versions(rows: DataFrame) -> DataFrame:
    """The row of the highest version of every id; a deletion is a row without a text hash."""
    values = [c for c in rows.columns if c not in ("id", STREAM, BATCH)]
    return _greatest_per_id(rows, values, F.col(VERSION))


def delete_missing(source: DataFrame, path: str, live: DataFrame | None = None) -> int:
    """Delete the ids of the index that the ``source``, a whole snapshot, lacks.

    A deletion is a row with the id alone, of a new version.  ``live`` may
    give the current ids from elsewhere.  Returns the version, or -1 if there
    was nothing to delete: a second call deletes nothing more.
    """
    spark = source.sparkSession
    stored = stored_rows(spark, path)
    if stored is None:
        return -1
    ids = (live if live is not None else current_index(spark, path)).select("id")
    gone = ids.join(source.select("id"), "id", "left_anti")
    version = next_version(stored)
    step = Step("deletions", version)
    rest = [f for f in stored.schema if f.name not in ("id", VERSION, STREAM, BATCH)]
    rows = gone.select(
        "id",
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest],
        F.lit(version).cast("long").alias(VERSION),
    )
    write_batch(rows, step, path)
    written = stored_rows(spark, path).where(step.mine())
    return -1 if written.isEmpty() else version


def current_index(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest row per id that is not deleted; None while nothing has been written."""
    rows = stored_rows(spark, path)
    if rows is None:
        return None
    return newest_versions(rows).where(F.col("text_hash").isNotNull()).drop(VERSION)


def monitor(
    events: DataFrame,
    path: str,
    checkpoint: str,
    delay: str = "10 minutes",
    width: str = "1 hour",
) -> StreamingQuery:
    """Windowed request counts, errors and latency of a log stream.

    Every batch adds its own counts per window; :func:`newest_windows` sums
    them, so an event corrects its window however late it comes, and no state
    is kept.  ``late`` counts the events that were older than the newest event
    of earlier batches by more than ``delay``.
    """

    def sink(df: DataFrame, step: Step) -> None:
        stored = stored_rows(df.sparkSession, path, step)
        newest = stored.agg(F.max("newest")).first()[0] if stored is not None else None
        overdue = F.col("ts") < F.lit(newest) - F.expr(f"INTERVAL {delay}")
        rows = df.withColumn("_late", overdue if newest is not None else F.lit(False))
        more = (F.count_if("_late").alias("late"), F.max("ts").alias("newest"))
        write_batch(windowed_activity(rows, "ts", width, more), step, path)

    return run_available(events, checkpoint, sink)


def newest_windows(spark: SparkSession, path: str) -> DataFrame:
    """The state of every window written by :func:`monitor`."""
    sums = [F.sum(c).alias(c) for c in ("requests", "errors", "latency_sum", "late")]
    return (
        spark.read.parquet(path)
        .groupBy("start")
        .agg(*sums, F.max("latency_max").alias("latency_max"))
        .select("start", "requests", "errors", "latency_sum", "latency_max", "late")
    )
