"""Top-k search: vectors, keywords and their fusion.

Exact scoring compares every query with every row, but no pair of them ever
becomes a row of a DataFrame.  Each task scores Arrow batches of its part of
the corpus against a block of queries as matrix products and keeps the best
``k`` per query; only those are shuffled.  Blocks of queries have a bounded
size and travel to the tasks one after the other, and the corpus is not moved
at all.  Approximate search keeps only what shares a hash code with the query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from casewright.functions.text import tokens
from casewright.operators.ranking import top_k
from casewright.session import shared_folder
from casewright.sources.tables import spread

# Queries sent to the tasks at once, in bytes.
QUERY_BYTES = 32 << 20
# Ranked hits up to this many bytes are broadcast.
HIT_BYTES = 32 << 20
# Rows, columns and queries of the matrices built at a time are limited by these.
SCORED_QUERIES = 512
# Scores are compared after rounding, so that summation order cannot reorder ties.
SCORE_DIGITS = 9
# Entries of a score matrix built at a time.
_MATRIX = 1 << 22

# (ids, corpus columns) and prepared queries -> matrix rows x queries; -inf = no hit
Scorer = Callable[[pa.Table, Any], np.ndarray]


class _Best:
    """The best ``k`` (score, id) per query seen so far; ties go to the lower id."""

    def __init__(self, n_queries: int, k: int) -> None:
        self.k = k
        self.scores: list[np.ndarray] = [np.empty(0)] * n_queries
        self.ids: list[np.ndarray | None] = [None] * n_queries

    def add(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        matrix = np.round(matrix, SCORE_DIGITS)
        for q in range(matrix.shape[1]):
            col = matrix[:, q]
            floor = self.scores[q][-1] if len(self.scores[q]) == self.k else -np.inf
            keep = (col >= floor) & (col > -np.inf)
            if not keep.any():
                continue
            s, i = col[keep], ids[keep]
            if len(s) > self.k:
                edge = np.partition(s, len(s) - self.k)[len(s) - self.k]
                s, i = s[s >= edge], i[s >= edge]
            if self.ids[q] is not None:
                s = np.concatenate([self.scores[q], s])
                i = np.concatenate([self.ids[q], i])
            order = np.lexsort((i, -s))[: self.k]
            self.scores[q], self.ids[q] = s[order], i[order]

    def rows(self, query_ids: list, schema: pa.Schema) -> pa.Table:
        found = [q for q, i in enumerate(self.ids) if i is not None]
        return pa.Table.from_arrays(
            [
                pa.array(
                    [query_ids[q] for q in found for _ in self.ids[q]], schema.field(0).type
                ),
                pa.array(
                    [x for q in found for x in self.ids[q].tolist()], schema.field(1).type
                ),
                pa.array(
                    np.concatenate([self.scores[q] for q in found]) if found else [], pa.float64()
                ),
            ],
            schema=schema,
        )


def _score_table(table: pa.Table, prepared: Any, best: _Best, scorer: Scorer, width: int) -> None:
    step = max(1, _MATRIX // max(1, width))
    for at in range(0, table.num_rows, step):
        part = table.slice(at, step)
        ids = part.column("id").to_numpy(zero_copy_only=False)
        best.add(ids, scorer(part, prepared))


def _blocks(queries: DataFrame, size: Callable[[Row], int], limit: int) -> Iterator[dict[str, list]]:
    """The queries as columns, in blocks of at most ``limit`` bytes, or one query."""
    names = queries.columns

    def columns(rows: list[Row]) -> dict[str, list]:
        return {n: [r[n] for r in rows] for n in names}

    rows: list[Row] = []
    held = 0
    for r in queries.toLocalIterator():
        rows.append(r)
        held += size(r)
        if held >= limit:
            yield columns(rows)
            rows, held = [], 0
    if rows:
        yield columns(rows)


def blocked_top_k(
    corpus: DataFrame,
    queries: Iterator[dict[str, list]],
    query_type: DataType,
    k: int,
    prepare: Callable[[dict[str, list]], Any],
    scorer: Scorer,
    width: Callable[[Any], int],
) -> DataFrame:
    """query_id, id, score and rank of the best ``k`` corpus rows per query.

    ``corpus`` has ``id`` and the columns of the scorer.  ``queries`` gives
    blocks of query columns; each block is one pass over the corpus, inside
    which ``SCORED_QUERIES`` queries are scored at a time.  ``prepare`` turns
    query columns into the scorer's form; ``width`` gives the matrix entries
    per corpus row.
    """
    id_type = corpus.schema["id"].dataType
    out_ddl = f"query_id {query_type.simpleString()}, id {id_type.simpleString()}, score double"
    schema = pa.schema(
        [
            ("query_id", to_arrow_type(query_type)),
            ("id", to_arrow_type(id_type)),
            ("score", pa.float64()),
        ]
    )

    def scan(columns: dict[str, list]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            groups = []
            for at in range(0, len(columns["query_id"]), SCORED_QUERIES):
                some = {n: v[at : at + SCORED_QUERIES] for n, v in columns.items()}
                groups.append((some["query_id"], prepare(some), _Best(len(some["query_id"]), k)))
            for batch in batches:
                table = pa.Table.from_batches([batch])
                if "vector" in table.column_names:
                    table = table.filter(pc.is_valid(table.column("vector")))
                for _, prepared, best in groups:
                    _score_table(table, prepared, best, scorer, width(prepared))
            for ids, _, best in groups:
                yield from best.rows(ids, schema).to_batches()

        return run

    partial = None
    for columns in queries:
        part = corpus.mapInArrow(scan(columns), out_ddl)
        partial = part if partial is None else partial.unionByName(part)
    if partial is None:
        partial = corpus.sparkSession.createDataFrame([], out_ddl)
    return top_k(partial, ["query_id"], [F.desc("score"), F.col("id")], k)


def apply_filters(df: DataFrame, filters: dict[str, Any] | str | Column | None) -> DataFrame:
    """Metadata filter before scoring: equalities, a SQL predicate or a Column."""
    if filters is None:
        return df
    if isinstance(filters, dict):
        for name, value in filters.items():
            df = df.where(F.col(name) == value)
        return df
    return df.where(F.expr(filters) if isinstance(filters, str) else filters)


# --- vectors ---------------------------------------------------------------


def _matrix(column: pa.ChunkedArray | list) -> np.ndarray:
    """Rows of equal length as a float64 matrix."""
    if isinstance(column, list):
        return np.array(column, dtype=np.float64).reshape(len(column), -1)
    arr = column.combine_chunks()
    flat = arr.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(arr), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _similarity(metric: str) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    if metric == "cosine":
        return lambda a, b: _unit(a) @ _unit(b).T
    if metric == "dot":
        return lambda a, b: a @ b.T
    if metric == "l2":
        # Negated distance, so that greater is better for every metric.  Plain
        # differences: expanding the square would lose the digits of small ones.
        return lambda a, b: -np.stack([np.linalg.norm(a - q, axis=1) for q in b], axis=1)
    raise ValueError(f"unknown metric {metric!r}")


def vector_search(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 5,
    metric: str = "cosine",
    filters: dict[str, Any] | str | Column | None = None,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """Best ``k`` corpus rows per query by vector similarity.

    ``corpus`` has id, vector and any filter columns; ``queries`` has query_id
    and vector.  Rows without a vector are passed over where they are scored:
    a filter on the column would be pushed down and embed every row twice.
    """
    similarity = _similarity(metric)
    rows = apply_filters(corpus, filters).select("id", "vector")
    asked = queries.select("query_id", "vector")

    def prepare(q: dict[str, list]) -> np.ndarray:
        return _matrix([v for v in q["vector"] if v is not None])

    def known(block: dict[str, list]) -> dict[str, list]:
        keep = [i for i, v in enumerate(block["vector"]) if v is not None]
        return {n: [v[i] for i in keep] for n, v in block.items()}

    def scorer(part: pa.Table, vectors: np.ndarray) -> np.ndarray:
        return similarity(_matrix(part.column("vector")), vectors)

    # A Python float in a list takes 32 bytes.
    blocks = _blocks(asked, lambda r: 32 * len(r["vector"] or ()) + 64, query_bytes)
    return blocked_top_k(
        rows,
        (x for b in blocks if (x := known(b))["query_id"]),
        asked.schema["query_id"].dataType,
        k,
        prepare,
        scorer,
        lambda v: v.shape[0],
    )


def candidate_pairs(corpus: DataFrame, queries: DataFrame) -> DataFrame:
    """query_id and id of every pair that shares the code of some table, once each.

    Both sides have ``codes``, an array with one code per table.  The tables'
    codes are joined by equality, so only rows in a query's buckets are met;
    a bucket with very many rows is split by the adaptive skew join.
    """
    rows = corpus.select("id", F.posexplode("codes").alias("table", "code"))
    asked = queries.select("query_id", F.posexplode("codes").alias("table", "code"))
    return rows.join(asked, ["table", "code"]).select("query_id", "id").distinct()


def candidate_counts(corpus: DataFrame, queries: DataFrame, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id and scored: how many ids :func:`candidate_pairs` gives a query, without making the pairs.

    The codes of an id are brought together once.  Each task turns its rows
    into one bit per row for every table and code; a query's candidates are
    the bits of its codes joined by OR, and only their number is shuffled.
    """
    folder = shared_folder(corpus.sparkSession, "codes")
    for side, name in ((corpus, "id"), (queries, "query_id")):
        known = side.where(F.col("codes").isNotNull()).select(name, "codes")
        known.groupBy(name).agg(F.collect_set("codes").alias("codes")).write.parquet(f"{folder}/{name}")
    read = corpus.sparkSession.read.parquet
    asked = read(f"{folder}/query_id")
    kind = queries.schema["query_id"].dataType
    schema = pa.schema([("query_id", to_arrow_type(kind)), ("scored", pa.int64())])

    def scan(columns: dict[str, list]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # A row per code list: most queries have one.
            owner = np.repeat(np.arange(len(columns["codes"])), [len(c) for c in columns["codes"]])
            wanted = np.array([c for cs in columns["codes"] for c in cs], np.int64)
            scored = np.zeros(len(columns["query_id"]), np.int64)
            for batch in batches:
                for at in range(0, batch.num_rows, _BIT_ROWS):
                    lists = batch.column("codes").slice(at, _BIT_ROWS)
                    for a in range(0, len(wanted), SCORED_QUERIES):
                        b = a + SCORED_QUERIES
                        bits = _bits_met(lists, wanted[a:b])
                        mine = owner[a:b]
                        if a and owner[a - 1] == mine[0]:
                            # The rest of the query before: what it met already does not count again.
                            bits[mine == mine[0]] |= rest
                            scored[mine[0]] -= int(np.bitwise_count(rest).sum(dtype=np.int64))
                        starts = np.flatnonzero(np.diff(mine, prepend=-1))
                        met = np.bitwise_or.reduceat(bits, starts, axis=0)
                        scored[mine[starts]] += np.bitwise_count(met).sum(1, dtype=np.int64)
                        rest = met[-1]
            yield pa.record_batch([pa.array(columns["query_id"], schema.field(0).type), pa.array(scored)], schema=schema)

        return run

    partial = corpus.sparkSession.createDataFrame([], f"query_id {kind.simpleString()}, scored long")
    rows = read(f"{folder}/id").select("codes")
    for columns in _blocks(asked, lambda r: 64 + sum(64 + 16 * len(c) for c in r["codes"]), query_bytes):
        partial = partial.unionByName(rows.mapInArrow(scan(columns), partial.schema))
    return partial.groupBy("query_id").agg(F.sum("scored").alias("scored")).where("scored > 0")


# Rows of a bit each that are compared at a time.
_BIT_ROWS = 8_192


def _bits_met(lists: pa.Array, wanted: np.ndarray) -> np.ndarray:
    """A bit per row of ``lists`` for each row of ``wanted``: whether a code list of it shares a code, table by table."""
    inner = lists.flatten()
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    codes = inner.flatten().to_numpy(zero_copy_only=False).reshape(len(inner), -1)
    bits = np.zeros((len(wanted), -(-len(lists) // 8)), np.uint8)
    for table in range(min(codes.shape[1], wanted.shape[1])):
        kinds, mine = np.unique(wanted[:, table], return_inverse=True)
        place = np.minimum(np.searchsorted(kinds, codes[:, table]), len(kinds) - 1)
        known = kinds[place] == codes[:, table]
        has = np.zeros((len(kinds), len(lists)), bool)
        has[place[known], row[known]] = True
        bits |= np.packbits(has, axis=1)[mine]
    return bits


def similarity_column(a: Column, b: Column, metric: str) -> Column:
    """Similarity of two vector columns; greater is better for every metric."""

    def total(x: Column, y: Column, f: Callable[[Column, Column], Column]) -> Column:
        parts = F.zip_with(x, y, lambda u, v: f(u.cast("double"), v.cast("double")))
        return F.aggregate(parts, F.lit(0.0), lambda s, p: s + p)

    def dot(x: Column, y: Column) -> Column:
        return total(x, y, lambda u, v: u * v)

    if metric == "cosine":
        return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))
    if metric == "dot":
        return dot(a, b)
    if metric == "l2":
        return -F.sqrt(total(a, b, lambda u, v: (u - v) * (u - v)))
    raise ValueError(f"unknown metric {metric!r}")


def approximate_search(
    corpus: DataFrame, queries: DataFrame, k: int = 5, metric: str = "cosine", query_bytes: int = QUERY_BYTES
) -> DataFrame:
    """Best ``k`` rows per query among those that share a bucket with it.

    ``corpus`` has id, vector and codes, ``queries`` query_id, vector and
    codes, see :func:`casewright.functions.embedding.plane_codes`.  The pairs
    are those of :func:`candidate_pairs`, but none becomes a row: vectors and
    codes of an id are brought together once, and each task scores its rows
    against the queries, counts only those whose codes meet (a bit per row),
    and keeps the best ``k`` of every query.  A vector that is missing, has a
    missing number or another length than the first query's has cosine 0, and
    no score by the other metrics, which ranks last.
    """
    similarity_column(F.col("vector"), F.col("vector"), metric)
    spark = corpus.sparkSession
    folder = shared_folder(spark, "buckets")
    for side, name in ((corpus, "id"), (queries, "query_id")):
        known = side.where(F.col(name).isNotNull()).groupBy(name)
        met = known.agg(F.collect_list(F.struct("vector")).alias("vectors"), F.collect_set("codes").alias("codes"))
        met.where(F.size("codes") > 0).write.parquet(f"{folder}/{name}")
    rows = spread(spark.read.parquet(f"{folder}/id"), "id")
    asked = spark.read.parquet(f"{folder}/query_id")
    kind, id_kind = queries.schema["query_id"].dataType, corpus.schema["id"].dataType
    schema = pa.schema([("query_id", to_arrow_type(kind)), ("id", to_arrow_type(id_kind)), ("score", pa.float64())])

    def scan(columns: dict[str, list]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            groups = []
            dims = next((len(v.vector) for vs in columns["vectors"] for v in vs if v.vector is not None), 0)
            for at in range(0, len(columns["query_id"]), SCORED_QUERIES):
                some = {n: v[at : at + SCORED_QUERIES] for n, v in columns.items()}
                groups.append(_Asked(some, dims, k, metric))
            for batch in batches:
                for at in range(0, batch.num_rows, _BIT_ROWS):
                    part = batch.slice(at, _BIT_ROWS)
                    lists = part.column("vectors")
                    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                    vectors = lists.flatten().field("vector")
                    ids = part.column("id").to_numpy(zero_copy_only=False)[row]
                    for group in groups:
                        met = group.met(part.column("codes"), part.num_rows)
                        for first in range(0, len(row), _BIT_ROWS):
                            some = slice(first, first + _BIT_ROWS)
                            group.add(ids[some], vectors[some], met[:, row[some]])
            for group in groups:
                yield group.rows(schema)

        return run

    out = f"query_id {kind.simpleString()}, id {id_kind.simpleString()}, score double"
    partial = spark.createDataFrame([], out)
    # A Python float in a list takes 32 bytes.
    blocks = _blocks(
        asked,
        lambda r: 64 + sum(32 * len(v.vector or ()) for v in r["vectors"]) + sum(64 + 16 * len(c) for c in r["codes"]),
        query_bytes,
    )
    for columns in blocks:
        partial = partial.unionByName(rows.mapInArrow(scan(columns), out))
    return top_k(partial, ["query_id"], [F.desc("score"), F.col("id")], k)


def _known_vectors(vectors: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of ``dims`` numbers as a matrix, with zeros for all others, and which they are."""
    lengths = np.nan_to_num(vectors.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = vectors.flatten()
    ends = np.r_[0, np.cumsum(lengths)]
    missing = np.r_[0, np.cumsum(flat.is_null().to_numpy(zero_copy_only=False))]
    known = (lengths == dims) & vectors.is_valid().to_numpy(zero_copy_only=False)
    known &= missing[ends[1:]] == missing[ends[:-1]]
    numbers = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(vectors), dims))
    if dims:
        out[known] = numbers[ends[:-1][known][:, None] + np.arange(dims)]
    return out, known


class _Asked:
    """Some queries of :func:`approximate_search` and the best rows met so far; ties go to the lower id."""

    def __init__(self, columns: dict[str, list], dims: int, k: int, metric: str) -> None:
        self.k, self.dims, self.metric, self.ids = k, dims, metric, columns["query_id"]
        # A row per vector and per code list: most queries have one of each.
        vectors = [v.vector for vs in columns["vectors"] for v in vs]
        self.of_vector = np.repeat(np.arange(len(self.ids)), [len(vs) for vs in columns["vectors"]])
        self.vectors, self.known = _known_vectors(pa.array(vectors, pa.list_(pa.float64())), dims)
        self.of_code = np.repeat(np.arange(len(self.ids)), [len(cs) for cs in columns["codes"]])
        self.codes = np.array([c for cs in columns["codes"] for c in cs], np.int64)
        self.floor = np.full(len(self.ids), -np.inf)
        self.best: list[tuple[np.ndarray, np.ndarray, np.ndarray] | None] = [None] * len(self.ids)

    def met(self, lists: pa.Array, n: int) -> np.ndarray:
        """Queries x rows: whether a code list of the row shares a code with one of the query, table by table."""
        bits = np.zeros((len(self.ids), -(-n // 8)), np.uint8)
        for at in range(0, len(self.codes), SCORED_QUERIES):
            mine = self.of_code[at : at + SCORED_QUERIES]
            starts = np.flatnonzero(np.diff(mine, prepend=-1))
            some = _bits_met(lists, self.codes[at : at + SCORED_QUERIES])
            bits[mine[starts]] |= np.bitwise_or.reduceat(some, starts, axis=0)
        return np.unpackbits(bits, axis=1, count=n).astype(bool)

    def _scores(self, rows: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            if self.metric == "l2":
                return -np.stack([np.linalg.norm(rows - q, axis=1) for q in self.vectors])
            dots = self.vectors @ rows.T
            if self.metric == "dot":
                return dots
            length = np.linalg.norm(self.vectors, axis=1)[:, None] * np.linalg.norm(rows, axis=1)
            return np.divide(dots, length, out=np.zeros_like(dots), where=length != 0)

    def add(self, ids: np.ndarray, vectors: pa.Array, met: np.ndarray) -> None:
        rows, known = _known_vectors(vectors, self.dims)
        scores = np.round(self._scores(rows), SCORE_DIGITS) + 0.0
        both = self.known[:, None] & known
        if self.metric == "cosine":
            scores[~both] = 0.0
            both[:] = True
        # The order of Spark: not a number is greatest, no score is least.
        order = np.where(both, np.where(np.isnan(scores), np.inf, scores), -np.inf)
        wanted = met[self.of_vector] & (order >= self.floor[self.of_vector][:, None])
        for v in np.flatnonzero(wanted.any(1)):
            q, at = self.of_vector[v], np.flatnonzero(wanted[v])
            if len(at) > self.k:
                edge = np.partition(order[v, at], len(at) - self.k)[len(at) - self.k]
                at = at[order[v, at] >= edge]
            found = (ids[at], scores[v, at], both[v, at])
            if self.best[q] is not None:
                found = tuple(np.concatenate(x) for x in zip(self.best[q], found))
            place = np.where(found[2], np.where(np.isnan(found[1]), np.inf, found[1]), -np.inf)
            first = np.lexsort((found[0], ~np.isnan(found[1]), -place, ~found[2]))[: self.k]
            self.best[q] = tuple(x[first] for x in found)
            if len(first) == self.k:
                self.floor[q] = place[first[-1]]

    def rows(self, schema: pa.Schema) -> pa.RecordBatch:
        found = [(q, *b) for q, b in zip(self.ids, self.best) if b is not None]
        scores = np.concatenate([np.zeros(0), *(s for _, _, s, _ in found)])
        missing = ~np.concatenate([np.zeros(0, bool), *(known for _, _, _, known in found)])
        columns = [
            pa.array([q for q, ids, _, _ in found for _ in ids], schema.field(0).type),
            pa.array([x for _, ids, _, _ in found for x in ids.tolist()], schema.field(1).type),
            pa.array(scores, pa.float64(), mask=missing),
        ]
        return pa.record_batch(columns, schema=schema)


def label_centroids(vectors: DataFrame, label: str = "label") -> DataFrame:
    """Mean vector per label as queries: query_id and vector.

    Averages are taken per (label, dimension), so a label with very many rows
    combines on the map side; what is gathered per label is one vector.
    """
    return (
        vectors.select(F.col(label).alias("query_id"), F.posexplode("vector"))
        .groupBy("query_id", "pos")
        .agg(F.avg(F.col("col").cast("double")).alias("v"))
        .groupBy("query_id")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("pv"))
        .select("query_id", F.col("pv.v").alias("vector"))
    )


# --- keywords --------------------------------------------------------------


def keyword_search(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 5,
    k1: float = 1.2,
    b: float = 0.75,
    filters: dict[str, Any] | str | Column | None = None,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """Best ``k`` corpus rows per query by BM25 (Robertson & Zaragoza 2009).

    ``corpus`` has id and text, ``queries`` has query_id and text.  Statistics
    are those of the filtered corpus, in which a null text is an empty one.
    Only terms of the queries are counted.  Rows without any query term are not hits.
    """
    found = F.coalesce(tokens(F.col("text")), F.array().cast("array<string>"))
    rows = apply_filters(corpus, filters).select("id", found.alias("terms"))
    asked = queries.select(
        "query_id", F.explode(F.array_distinct(tokens(F.col("text")))).alias("term")
    )
    # The empty term stands for the number of texts and their total length.
    vocabulary = asked.select("term").union(queries.sparkSession.range(1).select(F.lit(""))).distinct()
    met = rows.select(
        F.explode(F.array_append(F.array_distinct("terms"), "")).alias("term"),
        F.size("terms").cast("long").alias("length"),
    )
    # A small vocabulary is sent to the texts; beyond that, all terms are counted where they are first.
    few = vocabulary.count() * 64 <= HIT_BYTES
    if few:
        met = met.join(F.broadcast(vocabulary), "term", "left_semi")
    statistics = met.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("length").alias("length"))
    if not few:
        statistics = statistics.join(vocabulary, "term", "left_semi")
    folder = shared_folder(queries.sparkSession, "terms")
    statistics.write.parquet(folder)
    statistics = queries.sparkSession.read.schema(statistics.schema).parquet(folder)
    n, total = statistics.where(F.col("term") == "").select("df", "length").first() or (0, 0)
    weight = F.log1p((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)) * (k1 + 1)
    # One array per query, no longer than the query itself.
    weighted = (
        asked.join(statistics, "term")
        .groupBy("query_id")
        .agg(F.collect_list(F.struct("term", weight.alias("w"))).alias("tw"))
        .select("query_id", F.col("tw.term").alias("terms"), F.col("tw.w").alias("weights"))
    )
    blocks = _blocks(weighted, lambda r: 64 + sum(90 + len(t) for t in r["terms"]), query_bytes)
    # A long: a text's words times the number of texts soon pass an int.
    relative = F.size("terms").cast("long") * n / max(total, 1)
    prepared_rows = rows.select(
        "id", "terms", (F.lit(k1 * (1.0 - b)) + F.lit(k1 * b) * relative).alias("norm")
    )

    def prepare(q: dict[str, list]) -> tuple:
        vocabulary = sorted({t for ts in q["terms"] for t in ts})
        at = {t: i for i, t in enumerate(vocabulary)}
        weights = np.zeros((len(vocabulary), len(q["terms"])))
        for j, (ts, ws) in enumerate(zip(q["terms"], q["weights"], strict=True)):
            weights[[at[t] for t in ts], j] = ws
        return pa.array(vocabulary, pa.string()), weights

    def scorer(part: pa.Table, prepared: tuple) -> np.ndarray:
        vocabulary, weights = prepared
        lists = part.column("terms").combine_chunks()
        index = pc.index_in(lists.flatten(), value_set=vocabulary)
        row_of = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        known = index.is_valid().to_numpy(zero_copy_only=False)
        column = index.fill_null(0).to_numpy(zero_copy_only=False)[known].astype(np.int64)
        flat = row_of[known] * len(vocabulary) + column
        tf = np.bincount(flat, minlength=len(lists) * len(vocabulary)).astype(np.float64)
        tf = tf.reshape(len(lists), len(vocabulary))
        norm = part.column("norm").to_numpy()[:, None]
        scores = (tf / (tf + norm)) @ weights
        # Every weight is positive, so a positive score means a shared term.
        return np.where(scores > 0, scores, -np.inf)

    return blocked_top_k(
        prepared_rows,
        blocks,
        queries.schema["query_id"].dataType,
        k,
        prepare,
        scorer,
        lambda p: max(1, len(p[0]) + p[1].shape[1]),
    )


# --- fusion and reranking ---------------------------------------------------

RRF_K = 60


def fuse_ranks(rankings: list[DataFrame], k: int, rrf_k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion (Cormack et al. 2009) of query_id, id, rank lists."""
    parts = [r.select("query_id", "id", (1.0 / (F.col("rank") + rrf_k)).alias("s")) for r in rankings]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    fused = union.groupBy("query_id", "id").agg(F.round(F.sum("s"), SCORE_DIGITS).alias("score"))
    return top_k(fused, ["query_id"], [F.desc("score"), F.col("id")], k)


def hybrid_search(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 5,
    pool: int = 20,
    filters: dict[str, Any] | str | Column | None = None,
) -> DataFrame:
    """Best ``k`` rows by the fused ranks of vector and keyword search.

    ``corpus`` has id, text, vector and any filter columns, ``queries``
    query_id, text and vector.  Each search contributes its first ``pool``.
    """
    semantic = vector_search(corpus, queries, pool, filters=filters)
    keyword = keyword_search(corpus, queries, pool, filters=filters)
    return fuse_ranks([semantic, keyword], k)


def fuse_scores(rankings: list[tuple[DataFrame, float]], k: int) -> DataFrame:
    """Weighted sum of scores, each list scaled by its best score per query."""
    parts = []
    for hits, weight in rankings:
        best = hits.groupBy("query_id").agg(F.max("score").alias("best"))
        parts.append(
            hits.join(best, "query_id").select(
                "query_id", "id", (F.try_divide("score", "best") * weight).alias("s")
            )
        )
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    fused = union.groupBy("query_id", "id").agg(
        F.round(F.sum("s"), SCORE_DIGITS).alias("score")
    )
    return top_k(fused, ["query_id"], [F.desc("score"), F.col("id")], k)


def best_rank_union(rankings: list[DataFrame] | DataFrame, k: int) -> DataFrame:
    """Hits of several phrasings of a question merged by the best rank per id."""
    hits = rankings if isinstance(rankings, DataFrame) else None
    if hits is None:
        hits = rankings[0]
        for r in rankings[1:]:
            hits = hits.unionByName(r)
    merged = hits.groupBy("query_id", "id").agg(
        F.min("rank").alias("best_rank"), F.count(F.lit(1)).alias("votes")
    )
    return top_k(merged, ["query_id"], [F.col("best_rank"), F.desc("votes"), F.col("id")], k)


def token_jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two token arrays."""
    return F.coalesce(
        F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0)
    )


def attach(hits: DataFrame, corpus: DataFrame, n_queries: int, k: int) -> DataFrame:
    """Corpus columns for the first ``k`` hits of each of ``n_queries`` queries.

    The hits are at most ``k * n_queries`` rows of fixed width, but for ids
    that are text.  Within a bound they are sent to the corpus, whose texts
    then need no shuffle; beyond it, both sides are shuffled by id.
    """
    few = hits.where(F.col("rank") <= k)
    fixed = all(t in ("bigint", "int", "double") for _, t in few.select("query_id", "id").dtypes)
    if fixed and k * n_queries * 64 <= HIT_BYTES:
        few = F.broadcast(few)
    return corpus.join(few, "id")


def rerank(
    candidates: DataFrame,
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    pool: int = 50,
    score: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Second stage: score the first ``pool`` candidates again, keep the best ``k``.

    Only the candidates' texts are read into the second score.  ``score`` takes
    the query text and the row text.
    """
    score = score or (lambda q, t: token_jaccard(tokens(q), tokens(t)))
    stage = candidates.select("query_id", "id", "rank")
    rescored = (
        attach(stage, corpus.select("id", "text"), queries.count(), pool)
        .withColumnRenamed("rank", "first_rank")
        .join(queries.select("query_id", F.col("text").alias("_question")), "query_id")
        .select(
            "query_id",
            "id",
            "first_rank",
            F.round(score(F.col("_question"), F.col("text")), SCORE_DIGITS).alias("score"),
        )
    )
    return top_k(
        rescored, ["query_id"], [F.desc("score"), F.col("first_rank"), F.col("id")], k
    )


def compare_strategies(strategies: dict[str, DataFrame]) -> DataFrame:
    """Hits side by side: strategy, query_id, id, rank."""
    out = None
    for name, hits in strategies.items():
        part = hits.select(F.lit(name).alias("strategy"), "query_id", "id", "rank")
        out = part if out is None else out.unionByName(part)
    return out


def strategy_overlap(compared: DataFrame) -> DataFrame:
    """How many hits each query shares between strategies: the ids per vote count."""
    votes = compared.groupBy("query_id", "id").agg(F.count(F.lit(1)).alias("strategies"))
    return votes.groupBy("query_id", "strategies").agg(F.count(F.lit(1)).alias("ids"))


def result_rows(columns: Column, row: Column) -> Column:
    """map<name,value> of a result row, truncated to the shorter of the two."""
    n = F.least(F.size(columns), F.size(row))
    return F.map_from_arrays(F.slice(columns, F.lit(1), n), F.slice(row, F.lit(1), n))
