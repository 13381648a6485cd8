"""The case pipeline on a stream of file listings.

Keyed state, by buckets of cases, remembers the paths of every case, so a case
whose files come over several runs, in any order and however late, is taken up
in the run in which it becomes complete; a file that arrives for a complete
case, such as a royalty agreement, takes the case up again with all its
documents.  The state holds paths only; documents are read when their case is
taken up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from casewright.functions import paths
from casewright.operators import batch
from casewright.operators.cases import PATH_COLUMNS
from casewright.sources.tables import RUN
from casewright.streaming.jobs import VERSION, Step, newest_versions, next_version, run_available, stored_rows, write_batch

EVENTS = "events"
# The state is kept by buckets of cases: a call into Python for each case costs more than all else.
STATE_BUCKETS = 1_024
_EVENT = f"id string, {', '.join(f'{c} string' for c in PATH_COLUMNS)}, complete boolean"
_STATE = ", ".join(f"{c} array<string>" for c in ("id", *PATH_COLUMNS))


def role_paths(files: DataFrame) -> DataFrame:
    """One row per file of a case folder, its path in the column of its role."""
    path = F.col("path")
    role = F.when(F.lower(path).endswith(".pdf"), paths.role(path, ignore_case=False))
    return files.select(
        paths.case_folder(path).alias("id"),
        *[F.when(role == r, path).alias(c) for r, c in zip(paths.ROLES, PATH_COLUMNS)],
    ).where(F.col("id").isNotNull())


def follow_cases(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """What the cases of a bucket have after their new files, of those that have more than before.

    Of several files of a role the greatest path counts, as in a listing of
    all files at once.
    """
    known: dict[str, list[str | None]] = {}
    if state.exists:
        known = {id_: list(found) for id_, *found in zip(*state.get)}
    news: dict[str, list[str | None]] = {}
    for frame in frames:
        for id_, *found in zip(*(frame[c].tolist() for c in ("id", *PATH_COLUMNS))):
            now = known.get(id_)
            if now is None:
                now = news[id_] = known[id_] = [None] * len(PATH_COLUMNS)
            for i, path in enumerate(found):
                if isinstance(path, str) and (now[i] is None or path > now[i]):
                    now[i] = path
                    news[id_] = now
    if not news:
        return
    state.update((list(known), *map(list, zip(*known.values()))))
    events = pd.DataFrame(list(news.values()), index=list(news), columns=list(PATH_COLUMNS), dtype=object)
    events.insert(0, "id", list(news))
    yield events.assign(complete=events[PATH_COLUMNS[0]].notna() & events[PATH_COLUMNS[1]].notna())


def stream_cases(
    files: DataFrame, parsed: Callable[[SparkSession], DataFrame], root: str, checkpoint: str
) -> StreamingQuery:
    """Take up the cases that new files of the stream ``files`` (path) complete or add to.

    ``parsed`` reads the parsed documents known by then.  Every batch that has
    news writes its events, and the typed elements, unreadable documents,
    chunks and index entries of its cases, as a run of their tables; a retry
    replaces it.
    """

    def sink(df: DataFrame, step: Step) -> None:
        spark = df.sparkSession
        path = f"{root}/{EVENTS}"
        run = next_version(stored_rows(spark, path, step))
        write_batch(df.withColumn(VERSION, F.lit(run).cast("long")), step, path)
        events = stored_rows(spark, path).where(step.mine())
        ready = events.where("complete").select("id", *PATH_COLUMNS)
        known = parsed(spark).withColumn(RUN, F.lit(run).cast("long"))
        documents = batch.take_up_documents(known, ready, root, run)
        chunks = batch.write_chunks(documents, ready, root, run)
        batch.sync_chunk_index(chunks, root, run)

    events = (
        role_paths(files)
        .withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(STATE_BUCKETS)))
        .groupBy("bucket")
        .applyInPandasWithState(follow_cases, _EVENT, _STATE, "append", GroupStateTimeout.NoTimeout)
    )
    return run_available(events, checkpoint, sink)


def newest_events(spark: SparkSession, root: str) -> DataFrame:
    """id, paths, completeness and run of every case seen so far."""
    rows = spark.read.parquet(f"{root}/{EVENTS}").withColumn(RUN, F.col(VERSION))
    return newest_versions(rows).drop(VERSION)


def waiting_cases(spark: SparkSession, root: str) -> DataFrame:
    """Cases that lack an invoice or a declaration, with the run that last added to them."""
    return newest_events(spark, root).where("NOT complete").drop("complete")


def current_chunks(spark: SparkSession, root: str) -> DataFrame:
    """The chunks of every complete case, from the run that took it up last."""
    last = newest_events(spark, root).where("complete").select(F.col("id").alias("case_id"), RUN)
    chunks = stored_rows(spark, f"{root}/{batch.CHUNKS}")
    return last.limit(0) if chunks is None else chunks.join(last, ["case_id", RUN], "left_semi")
