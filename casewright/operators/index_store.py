"""A stored search index that lives: changes, deletions, compaction, keyword postings.

Below one root lie

* ``log``: what the sync job wrote, every version of every row.  A row whose
  ``text_hash`` is NULL says that its id was deleted;
* ``rows``: the current row of every id, in buckets by hash of the id;
* ``postings``: for each bucket, the texts of every term in blocks of
  ``BLOCK`` texts, ordered by term, with what bounds the scores of a block;
* ``manifest``: which generation of each bucket is current, and how far into
  the log it reaches.  It is written last, so a compaction that breaks off
  leaves the index as it was.

A search reads current buckets as they are: nothing is aggregated by id.  A
compaction aggregates the log's new versions alone, and rewrites only buckets
that hold an id of theirs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from casewright.functions.text import tokens
from casewright.operators.ranking import top_k
from casewright.operators.search import (
    _MATRIX,
    QUERY_BYTES,
    SCORED_QUERIES,
    _Best,
    _blocks,
    fuse_ranks,
    vector_search,
)
from casewright.streaming.jobs import (
    BATCH,
    STREAM,
    VERSION,
    Step,
    index_batch,
    newest_versions,
    stored_rows,
    sync_index,
    without_ids,
)

LOG, ROWS, POSTINGS, MANIFEST = "log", "rows", "postings", "manifest"
# A bucket is searched by one task: there are at least so many buckets, and more where the first compaction
# would put more rows or tokens into one.
BUCKETS = 16
BUCKET_ROWS, BUCKET_TOKENS = 100_000, 50_000_000
# Texts per block of postings, and postings that a task holds at a time to make blocks of.
BLOCK = 128
HELD = 2_000_000
# Words of a text that cross to Python in one row.
LISTED_WORDS = 1_024
# The stored tables are compressed more than by default: they are written once and read in parts.
PACKED = {"compression": "zstd"}
# Query terms that are pushed into the scan as a list.
LISTED_TERMS = 5_000
# Scores closer than this are not told apart when blocks are left out.
NEAR = 1e-9


class Snapshot(NamedTuple):
    """The current state of a stored index."""

    root: str
    number: int
    through: int
    buckets: int
    # bucket -> (generation, rows, tokens)
    parts: dict[int, tuple[int, int, int]]

    @property
    def rows(self) -> int:
        return sum(p[1] for p in self.parts.values())

    @property
    def tokens(self) -> int:
        return sum(p[2] for p in self.parts.values())

    def folders(self, table: str, only: set[int] | None = None) -> list[str]:
        return [
            f"{self.root}/{table}/generation={generation}/bucket={bucket}"
            for bucket, (generation, rows, _) in sorted(self.parts.items())
            if rows and (only is None or bucket in only)
        ]


def _ascii_tokens(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of each token of texts in plain characters, and the tokens, as :func:`tokens` finds them."""
    texts = pa.concat_arrays([texts.fill_null("")]).cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[ends[0] : ends[-1]] if held is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    letters = _TOKEN_BYTES[data]
    inside = letters > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    # A text begins a token even where the text before it ends in one.
    begins = ends[:-1][ends[:-1] < len(data)]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    row = np.searchsorted(ends, starts, "right") - 1
    place = np.cumsum(inside)
    offsets = np.append(place[starts] - 1, place[-1] if len(place) else 0).astype(np.int32)
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters[inside]))
    return row, found


# The lower case of the characters of tokens, 0 for all others.
_TOKEN_BYTES = np.zeros(256, np.uint8)
for _c in range(128):
    if chr(_c).isalnum():
        _TOKEN_BYTES[_c] = ord(chr(_c).lower())


def term_counts(text: Column) -> Column:
    """array<struct<term,tf>>: the different tokens of a text and how often each occurs."""

    @F.arrow_udf("array<struct<term:string,tf:int>>")
    def counted(texts: pa.Array, words: pa.Array) -> pa.Array:
        row, plain = _ascii_tokens(texts)
        lengths = np.nan_to_num(words.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        row = np.concatenate([row, np.repeat(np.arange(len(words)), lengths)])
        coded = pa.concat_arrays([plain, words.flatten().cast(pa.string())]).dictionary_encode()
        kinds = max(1, len(coded.dictionary))
        pairs, counts = np.unique(
            row * kinds + coded.indices.to_numpy(zero_copy_only=False), return_counts=True
        )
        terms = coded.dictionary.take(pa.array((pairs % kinds).astype(np.int64)))
        offsets = np.searchsorted(pairs // kinds, np.arange(len(words) + 1)).astype(np.int32)
        entries = pa.StructArray.from_arrays([terms, pa.array(counts.astype(np.int32))], ["term", "tf"])
        return pa.ListArray.from_arrays(pa.array(offsets), entries)

    # Texts in plain characters are cut where they are counted; which others are letters, the JVM knows.
    # A list is empty rather than null: Arrow's writer goes over all nulls before a row again and again.
    plain = F.length(text) == F.octet_length(text)
    none = F.array().cast("array<string>")
    return counted(F.when(plain, text), F.when(~plain, tokens(text)).otherwise(none))


def text_columns(rows: DataFrame, vector: Column | None = None, *more: str) -> DataFrame:
    """What the index keeps of rows (id, text, text_hash): words, and a vector if one is given, not the text."""
    counted = rows.withColumn("words", term_counts(F.col("text")))
    length = F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + w.tf)
    vectors = [] if vector is None else [vector.alias("vector")]
    return counted.select("id", "text_hash", *more, *vectors, "words", length.alias("length"))


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def open_store(spark: SparkSession, root: str, buckets: int = BUCKETS) -> Snapshot:
    """The newest snapshot; one without rows while nothing has been compacted."""
    manifest = stored_rows(spark, f"{root}/{MANIFEST}")
    if manifest is None:
        return Snapshot(root, -1, -1, buckets, {})
    number = manifest.agg(F.max("number")).first()[0]
    parts = manifest.where(F.col("number") == number).collect()
    one = parts[0]
    return Snapshot(
        root, number, one.through, one.buckets, {p.bucket: (p.generation, p.rows, p.tokens) for p in parts}
    )


def live_rows(spark: SparkSession, snapshot: Snapshot, only: set[int] | None = None) -> DataFrame:
    """Current rows, as they are stored, of all buckets or some."""
    return _read(spark, snapshot, ROWS, only)


def _read(spark: SparkSession, snapshot: Snapshot, table: str, only: set[int] | None = None) -> DataFrame:
    folders = snapshot.folders(table, only)
    if not folders:
        log = stored_rows(spark, f"{snapshot.root}/{LOG}")
        if log is None:
            raise ValueError(f"nothing is stored below {snapshot.root}")
        return log.drop(STREAM, BATCH).withColumn("bucket", F.lit(0)).limit(0)
    return spark.read.option("basePath", f"{snapshot.root}/{table}").parquet(*folders).drop("generation")


def known_hashes(spark: SparkSession, root: str, without: Step | None = None) -> DataFrame | None:
    """(id, text_hash) of every current row: buckets as they are, and the log behind them.

    Rows of the step ``without`` do not count while they are in the log.
    """
    log = stored_rows(spark, f"{root}/{LOG}", without)
    if log is None:
        return None
    snapshot = open_store(spark, root)
    tail = newest_versions(log.where(F.col(VERSION) > snapshot.through).select("id", "text_hash", VERSION))
    known = tail.where(F.col("text_hash").isNotNull()).select("id", "text_hash")
    if snapshot.rows:
        rows = live_rows(spark, snapshot).select("id", "text_hash")
        known = known.unionByName(rows.join(tail.select("id"), "id", "left_anti"))
    return known


def sync(
    chunks: DataFrame,
    root: str,
    checkpoint: str,
    embed: Callable[[DataFrame], DataFrame],
    order: str | None = None,
) -> StreamingQuery:
    """Write new and changed chunks of a stream to the log of the index.

    ``embed`` gives the columns to store; ``words`` (:func:`term_counts`) and
    ``length`` are what postings are made of.
    """
    return sync_index(
        chunks, f"{root}/{LOG}", checkpoint, embed, order, lambda spark, step: known_hashes(spark, root, step)
    )


def sync_rows(rows: DataFrame, root: str, step: Step, embed: Callable[[DataFrame], DataFrame]) -> None:
    """Write the new and changed ones of some rows (id, text) to the log, as one step."""
    known = lambda spark, mine: known_hashes(spark, root, mine)
    index_batch(rows, step, f"{root}/{LOG}", embed, known=known)


def compact(spark: SparkSession, root: str, buckets: int | None = None) -> Snapshot:
    """Bring rows and postings up to the end of the log; returns the new snapshot.

    Without new versions in the log nothing is written.  ``buckets`` counts
    only for the first compaction, which else takes as many as its rows need.
    Rows of the log move once, to their buckets; rows that lie in a bucket
    already are written from where they are read.
    """
    old = open_store(spark, root, buckets or BUCKETS)
    log = stored_rows(spark, f"{root}/{LOG}")
    if log is None:
        return old
    tail = log.where(F.col(VERSION) > old.through)
    through = tail.agg(F.max(VERSION)).first()[0]
    if through is None:
        return old
    if old.number < 0 and buckets is None:
        old = old._replace(buckets=_wanted_buckets(tail))
    bucket = bucket_of(F.col("id"), old.buckets)
    touched = {r.bucket for r in tail.select(bucket.alias("bucket")).distinct().collect()}
    newest = newest_versions(tail).where(F.col("text_hash").isNotNull()).withColumn("bucket", bucket)
    moved = _unpacked(_packed(newest).repartition("bucket")).select(*newest.columns)
    rows = moved
    if old.folders(ROWS, touched):
        kept = without_ids(live_rows(spark, old, touched), tail.select("id").distinct())
        rows = kept.unionByName(moved, allowMissingColumns=True)
    number = old.number + 1
    folder = f"{root}/{ROWS}/generation={number}"
    ordered = rows.sortWithinPartitions("bucket", "id")
    ordered.write.mode("overwrite").options(**PACKED).partitionBy("bucket").parquet(folder)
    # Reading it back with the log's columns works for a generation without rows, too.
    written = spark.read.schema(rows.schema).parquet(folder)
    length = F.sum("length") if "length" in rows.columns else F.lit(0)
    sizes = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), length.alias("tokens")).collect()
    if "words" in rows.columns:
        target = f"{root}/{POSTINGS}/generation={number}"
        blocks_of(written).write.mode("overwrite").options(**PACKED).partitionBy("bucket").parquet(target)
    parts = dict(old.parts) | {b: (number, 0, 0) for b in touched}
    parts |= {s.bucket: (number, s.rows, s.tokens or 0) for s in sizes}
    entries = [(b, *p, through, old.buckets) for b, p in sorted(parts.items())]
    columns = "bucket int, generation int, rows long, tokens long, through long, buckets int"
    spark.createDataFrame(entries, columns).coalesce(1).write.mode("overwrite").parquet(
        f"{root}/{MANIFEST}/number={number}"
    )
    return Snapshot(root, number, through, old.buckets, parts)


def _wanted_buckets(tail: DataFrame) -> int:
    tokens = F.sum("length") if "length" in tail.columns else F.lit(0)
    size = tail.agg(F.count(F.lit(1)).alias("rows"), tokens.alias("tokens")).first()
    return max(BUCKETS, -(-size.rows // BUCKET_ROWS), -(-(size.tokens or 0) // BUCKET_TOKENS))


def _packed(rows: DataFrame) -> DataFrame:
    """Words as two texts, a fifth of what an array of structs takes in a shuffle; tokens have no blanks."""
    if "words" not in rows.columns:
        return rows
    words = F.col("words")
    return rows.withColumns(
        {
            "_terms": F.when(words.isNotNull(), F.concat_ws(" ", words["term"])),
            "_counts": F.when(words.isNotNull(), F.concat_ws(" ", words["tf"].cast("array<string>"))),
        }
    ).drop("words")


def _unpacked(rows: DataFrame) -> DataFrame:
    if "_terms" not in rows.columns:
        return rows
    kind = "array<struct<term:string,tf:int>>"
    pairs = F.arrays_zip(F.split("_terms", " "), F.split("_counts", " ").cast("array<int>")).cast(kind)
    none = F.array().cast(kind)
    return rows.withColumn("words", F.when(F.col("_terms") == "", none).otherwise(pairs)).drop("_terms", "_counts")


def blocks_of(rows: DataFrame) -> DataFrame:
    """Postings of (bucket, id, length, words) in blocks, ordered by term inside each bucket.

    Every task makes blocks of the rows it reads, so nothing is shuffled: a
    term of a bucket that several tasks read has blocks of each of them.
    """
    kind = rows.schema["id"].dataType.simpleString()
    schema = (
        "bucket int, term string, block int, texts long, most int, shortest long, "
        f"postings array<struct<id:{kind},tf:int,length:long>>"
    )
    # Lists cross to Python at a quarter of what rows of single words cost; a long text's list comes in pieces.
    words, count = F.col("words"), F.size("words")
    starts = F.sequence(F.lit(1), count, F.lit(LISTED_WORDS))
    pieces = F.when(count <= LISTED_WORDS, F.array(words)).otherwise(
        F.transform(starts, lambda i: F.slice(words, i, F.lit(LISTED_WORDS)))
    )
    rows = rows.where(count > 0)
    listed = rows.select("bucket", "id", F.col("length").cast("long").alias("length"), F.explode(pieces).alias("w"))
    each = listed.select("bucket", "id", "length", F.col("w.term").alias("terms"), F.col("w.tf").alias("counts"))
    blocks = each.mapInArrow(_inverter(BLOCK, HELD, schema), schema)
    return blocks.sortWithinPartitions("bucket", "term", "block")


def _inverter(
    block: int, held: int, schema: str
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Groups postings by bucket and term, ``held`` of them at a time, in the order they come."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    entry = arrow.field("postings").type.value_type

    def inverted(table: pa.Table, first: int) -> pa.Table:
        lists = table.column("terms").combine_chunks()
        row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        coded = lists.flatten().dictionary_encode()
        term = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        bucket = table.column("bucket").to_numpy().astype(np.int64)[row]
        key = bucket * max(1, len(coded.dictionary)) + term
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        place = np.arange(len(key)) - np.repeat(starts, sizes)
        at = np.flatnonzero(place % block == 0)
        tf = table.column("counts").combine_chunks().flatten().to_numpy()[order]
        length = table.column("length").to_numpy()[row[order]]
        ids = table.column("id").combine_chunks().take(pa.array(row[order]))
        entries = pa.StructArray.from_arrays([ids, pa.array(tf), pa.array(length)], fields=list(entry))
        ends = np.r_[at, len(key)]
        return pa.Table.from_arrays(
            [
                pa.array(bucket[order[at]].astype(np.int32)),
                coded.dictionary.take(pa.array(term[order[at]])).cast(arrow.field("term").type),
                pa.array((first + place[at] // block).astype(np.int32)),
                pa.array(np.diff(ends)),
                pa.array(np.maximum.reduceat(tf, at)),
                pa.array(np.minimum.reduceat(length, at)),
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), entries),
            ],
            schema=arrow,
        )

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        count = first = 0
        for batch in batches:
            waiting.append(batch)
            count += len(batch.column("terms").flatten())
            if count >= held:
                yield from inverted(pa.Table.from_batches(waiting), first).to_batches(2_000)
                # A term has at most so many blocks of what was held: numbers do not come twice in a task.
                first += -(-count // block)
                waiting, count = [], 0
        if count:
            yield from inverted(pa.Table.from_batches(waiting), first).to_batches(2_000)

    return invert


# --- keyword search ------------------------------------------------------------------


class _Norm(NamedTuple):
    """BM25's part of a score that a posting decides: tf / (tf + flat + slope * length)."""

    flat: float
    slope: float

    def column(self, tf: str, length: str) -> Column:
        return F.col(tf) / (F.col(tf) + self.flat + self.slope * F.col(length))


def keyword_search(
    spark: SparkSession,
    snapshot: Snapshot,
    queries: DataFrame,
    k: int = 5,
    k1: float = 1.2,
    b: float = 0.75,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """Best ``k`` rows per query by BM25, from the postings of the queries' terms.

    ``queries`` has query_id and text.  The scores are those of a search of
    all texts.  For each block of queries the terms' best blocks give a lower
    bound of every query's k-th score; a block of postings in which no text
    can reach the bound of any query, with all that its bucket could add from
    the query's other terms, is not read further.
    """
    postings = _read(spark, snapshot, POSTINGS) if snapshot.rows else None
    asked = queries.select("query_id", F.array_distinct(tokens(F.col("text"))).alias("terms"))
    kind = queries.schema["query_id"].dataType.simpleString()
    partial = None
    blocks = _blocks(asked, lambda r: 64 + sum(90 + len(t) for t in r["terms"] or ()), query_bytes)
    for block in blocks if postings is not None else ():
        part = _block_hits(spark, snapshot, postings, block, kind, k, k1, b)
        if part is not None:
            partial = part if partial is None else partial.unionByName(part)
    if partial is None:
        ids = _read(spark, snapshot, ROWS).schema["id"].dataType.simpleString()
        partial = spark.createDataFrame([], f"query_id {kind}, id {ids}, score double")
    return top_k(partial, ["query_id"], [F.desc("score"), F.col("id")], k)


def _block_hits(
    spark: SparkSession,
    snapshot: Snapshot,
    postings: DataFrame,
    block: dict[str, list],
    kind: str,
    k: int,
    k1: float,
    b: float,
) -> DataFrame | None:
    n = snapshot.rows
    norm = _Norm(k1 * (1.0 - b), k1 * b * n / max(snapshot.tokens, 1))
    words = sorted({t for ts in block["terms"] for t in ts or ()})
    if not words:
        return None
    met = _with_terms(spark, postings, words).withColumn("bound", norm.column("most", "shortest"))
    statistics = {r.term: r for r in term_statistics(met, norm, k).collect()}
    weight = {
        t: float(np.log1p((n - r.df + 0.5) / (r.df + 0.5)) * (k1 + 1)) for t, r in statistics.items()
    }
    asking = [(q, [t for t in ts or () if t in weight]) for q, ts in zip(block["query_id"], block["terms"])]
    asking = [(q, ts) for q, ts in asking if ts]
    if not asking:
        return None
    # k texts have at least the k-th best part of any one term of the query.
    floors = [max(weight[t] * statistics[t].floor for t in ts) for _, ts in asking]
    needed = needed_bounds(spark, met, asking, weight, floors)
    kept = met.join(needed, ["term", "bucket"]).where(F.col("bound") >= F.col("needed") - NEAR)
    id_kind = postings.schema["postings"].dataType.elementType["id"].dataType.simpleString()
    schema = f"query_id {kind}, id {id_kind}, score double"
    score = _scorer(asking, weight, norm, k, schema)
    return kept.select("bucket", "term", "postings").groupBy("bucket").applyInArrow(score, schema)


def _with_terms(spark: SparkSession, postings: DataFrame, words: list[str]) -> DataFrame:
    if len(words) <= LISTED_TERMS:
        return postings.where(F.col("term").isin(words))
    # At most as many words as a block of queries has.
    listed = spark.createDataFrame([(w,) for w in words], "term string")
    return postings.join(F.broadcast(listed), "term", "left_semi")


def term_statistics(met: DataFrame, norm: _Norm, k: int) -> DataFrame:
    """term, df and floor: what at least ``k`` postings of the term reach, 0 if it has fewer.

    Its ``k`` blocks of greatest bounds hold that many postings, if there are.
    """
    counts = met.groupBy("term").agg(F.sum("texts").alias("df"))
    best = Window.partitionBy("term").orderBy(F.desc("bound"), "bucket", "block")
    seeds = (
        met.select("term", "bucket", "block", "bound", "postings")
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= k)
        .select("term", F.inline("postings"))
        .select("term", norm.column("tf", "length").alias("impact"))
    )
    ranked = seeds.withColumn(
        "place", F.row_number().over(Window.partitionBy("term").orderBy(F.desc("impact")))
    )
    floors = ranked.where(F.col("place") == k).select("term", F.col("impact").alias("floor"))
    return counts.join(floors, "term", "left").select("term", "df", F.coalesce("floor", F.lit(0.0)).alias("floor"))


def needed_bounds(
    spark: SparkSession,
    met: DataFrame,
    asking: list[tuple],
    weight: dict[str, float],
    floors: list[float],
) -> DataFrame:
    """For every term and bucket, the least bound a block needs to matter to some query.

    A query's texts in a bucket score at most the sum of what its terms reach
    there; a block has to make up for how far that sum is above the floor.
    """
    terms = [(i, t, weight[t], floors[i]) for i, (_, ts) in enumerate(asking) for t in ts]
    wanted = F.broadcast(spark.createDataFrame(terms, "q int, term string, weight double, floor double"))
    tops = met.groupBy("term", "bucket").agg(F.max("bound").alias("top"))
    reach = tops.join(wanted, "term")
    sums = reach.groupBy("q", "bucket").agg(F.sum(F.col("weight") * F.col("top")).alias("reach"))
    return (
        reach.join(sums, ["q", "bucket"])
        .where(F.col("reach") >= F.col("floor") - NEAR)
        .groupBy("term", "bucket")
        .agg(F.min((F.col("floor") - F.col("reach")) / F.col("weight") + F.col("top")).alias("needed"))
    )


def _scorer(
    asking: list[tuple], weight: dict[str, float], norm: _Norm, k: int, schema: str
) -> Callable[[pa.Table], pa.Table]:
    """Scores the texts of a bucket as a matrix product and keeps the best per query."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def score(table: pa.Table) -> pa.Table:
        lists = table.column("postings").combine_chunks()
        entries = lists.flatten()
        coded = table.column("term").combine_chunks().dictionary_encode()
        words = coded.dictionary.to_pylist()
        at = {t: i for i, t in enumerate(words)}
        term = np.repeat(coded.indices.to_numpy(), lists.value_lengths().to_numpy()).astype(np.int64)
        tf = entries.field("tf").to_numpy().astype(np.float64)
        part = tf / (tf + norm.flat + norm.slope * entries.field("length").to_numpy())
        ids, text = np.unique(entries.field("id").to_numpy(zero_copy_only=False), return_inverse=True)
        order = np.argsort(text, kind="stable")
        term, part, text = term[order], part[order], text[order]
        out = []
        step = max(1, _MATRIX // max(len(words), SCORED_QUERIES))
        for a in range(0, len(asking), SCORED_QUERIES):
            some = asking[a : a + SCORED_QUERIES]
            weights = np.zeros((len(words), len(some)))
            for j, (_, ts) in enumerate(some):
                for t in ts:
                    if t in at:
                        weights[at[t], j] = weight[t]
            best = _Best(len(some), k)
            for first in range(0, len(ids), step):
                x, y = np.searchsorted(text, [first, first + step])
                count = min(step, len(ids) - first)
                cells = (text[x:y] - first) * len(words) + term[x:y]
                parts = np.bincount(cells, part[x:y], count * len(words)).reshape(count, len(words))
                scores = parts @ weights
                best.add(ids[first : first + count], np.where(scores > 0, scores, -np.inf))
            out.append(best.rows([q for q, _ in some], arrow))
        return pa.concat_tables(out)

    return score


def hybrid_search(
    spark: SparkSession, snapshot: Snapshot, queries: DataFrame, k: int = 5, pool: int = 20
) -> DataFrame:
    """Best ``k`` rows by the fused ranks of stored vectors and stored postings.

    ``queries`` has query_id, text and vector.
    """
    semantic = vector_search(live_rows(spark, snapshot).select("id", "vector"), queries, pool)
    return fuse_ranks([semantic, keyword_search(spark, snapshot, queries, pool)], k)
