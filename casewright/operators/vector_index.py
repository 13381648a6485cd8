"""Approximate search through an inverted file of cells with byte codes.

A model is fitted on a bounded sample: centres of cells by a few rounds of
spherical k-means, and a margin.  Every row of the corpus is stored with its
cell and its direction in one byte per dimension, ordered by cell.  A query
looks into all cells whose centres are nearly as close to it as the closest
one: nearly means within the margin, which is measured, not guessed, as the
one that would have kept a target share of the sample's true neighbours.  The
rows met are ranked by their codes alone; only a short list is scored with the
stored vectors.  So a search reads the narrow codes of the corpus, which never
move, and a few vectors for each query.

Codes and centres are whole numbers and compared by whole products, so cells,
margins and short lists are the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from casewright.operators.ranking import top_k
from casewright.operators.search import (
    QUERY_BYTES,
    SCORE_DIGITS,
    _blocks,
    attach,
    blocked_top_k,
    similarity_column,
)

# A component of a unit vector is stored as so many parts of one.
UNIT = 127
# Rows the model is fitted on, at most, and those of them that calibrate the margin.
SAMPLE_ROWS = 16_384
CALIBRATION_ROWS = 256
# Sample rows per cell, and the most cells: the centres travel with every task.
ROWS_PER_CELL = 4
MOST_CELLS = 4_096
ROUNDS = 2
# Share of the sample's true neighbours whose cells the margin has to reach.
TARGET = 0.97
NEIGHBOURS = 10
# Products of rows and centres held at a time.
PRODUCTS = 1 << 20
# Rows scored exactly for each row asked for.
SHORT = 4


class Model(NamedTuple):
    """Codes of the cells' centres, and how far behind the best a probed centre may be."""

    centres: np.ndarray
    margin: int


def codes_of(vectors: np.ndarray) -> np.ndarray:
    """Directions in parts of ``UNIT``, as whole numbers; zeros for a vector of zeros."""
    norm = np.sqrt((vectors * vectors).sum(1, keepdims=True))
    scaled = np.divide(UNIT * vectors, norm, out=np.zeros_like(vectors), where=norm > 0)
    return np.floor(scaled + 0.5)


def _slices(rows: int, centres: np.ndarray) -> list[slice]:
    """Runs of rows whose products with all centres are at most ``PRODUCTS``."""
    step = max(1, PRODUCTS // max(1, len(centres)))
    return [slice(at, at + step) for at in range(0, rows, step)]


def nearest(codes: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The cell of each row: the centre of greatest product, of equals the first."""
    cells = [(codes[s] @ centres.T).argmax(1) for s in _slices(len(codes), centres)]
    return np.concatenate(cells) if cells else np.zeros(0, np.int64)


def _rows(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _packed(codes: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in codes.astype(np.int8)], pa.binary())


def _unpacked(column: pa.Array) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), np.int8).astype(np.float64)
    return flat.reshape(len(column), -1)


def sample_rows(vectors: DataFrame, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Vectors of the ``rows`` ids of least MD5 digest: a sample that no order of files changes."""
    order = F.md5(F.col("id").cast("string"))
    some = vectors.where(F.col("vector").isNotNull()).orderBy(order, "id").limit(rows)
    return np.array([r.vector for r in some.select("vector").collect()], np.float64)


def fit(
    vectors: DataFrame,
    rows: int = SAMPLE_ROWS,
    cells: int | None = None,
    target: float = TARGET,
    k: int = NEIGHBOURS,
) -> Model:
    """Cells and margin from a sample of at most ``rows`` rows of (id, vector).

    By default a cell for every ``ROWS_PER_CELL`` sampled rows.
    """
    sample = sample_rows(vectors, rows)
    if not len(sample):
        return Model(np.zeros((0, 0)), 0)
    codes = codes_of(sample)
    cells = min(len(codes), cells or max(1, min(MOST_CELLS, len(codes) // ROWS_PER_CELL)))
    centres = codes[:cells].copy()
    for _ in range(ROUNDS):
        cell = nearest(codes, centres)
        for c in np.unique(cell):
            centres[c] = codes_of(codes[cell == c].mean(0)[None])[0]
    return Model(centres, margin_of(codes, centres, target, k))


def margin_of(codes: np.ndarray, centres: np.ndarray, target: float, k: int) -> int:
    """The margin that reaches the cells of a ``target`` share of the true neighbours.

    The last rows of the sample search it; the first ones were the seeds of
    the centres and lie too close to them.  A neighbour is reached if its
    cell's centre is behind the best centre by the margin at most.
    """
    places = np.arange(len(codes))[-CALIBRATION_ROWS:]
    asked = codes[places]
    cell = nearest(codes, centres)
    products = asked @ codes.T
    products[np.arange(len(asked)), places] = -np.inf
    close = np.argsort(-products, axis=1, kind="stable")[:, : min(k, len(codes) - 1)]
    to_centres = asked @ centres.T
    gaps = to_centres.max(1, keepdims=True) - np.take_along_axis(to_centres, cell[close], axis=1)
    gaps = np.sort(gaps.ravel())
    return int(gaps[int(np.ceil(target * len(gaps))) - 1]) if len(gaps) else 0


def byte_codes(vector: Column) -> Column:
    """One byte per dimension of each vector."""

    @F.arrow_udf("binary")
    def packed(vectors: pa.Array) -> pa.Array:
        return _packed(codes_of(_rows(vectors)))

    return packed(vector)


def cell_of(code: Column, model: Model) -> Column:
    @F.arrow_udf("int")
    def cells(codes: pa.Array) -> pa.Array:
        return pa.array(nearest(_unpacked(codes), model.centres).astype(np.int32))

    return cells(code)


def build(vectors: DataFrame, model: Model, path: str) -> DataFrame:
    """Write every row with its cell and code, ordered by cell; returns the stored index.

    Files are ranges of (cell, id), so a cell with very many rows has several.
    Rows without a vector are left out.
    """
    coded = vectors.where(F.col("vector").isNotNull()).withColumn("code", byte_codes(F.col("vector")))
    placed = coded.withColumn("cell", cell_of(F.col("code"), model))
    placed.repartitionByRange("cell", "id").sortWithinPartitions("cell", "id").write.parquet(path)
    return vectors.sparkSession.read.schema(placed.schema).parquet(path)


def probes(codes: np.ndarray, model: Model) -> np.ndarray:
    """queries x cells: which cells each query looks into."""
    if not len(model.centres):
        return np.zeros((len(codes), 0), bool)
    products = codes @ model.centres.T
    return products >= products.max(1, keepdims=True) - model.margin


def cells_probed(codes: np.ndarray, model: Model) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of queries and the cells they look into, some queries at a time."""
    for s in _slices(len(codes), model.centres):
        q, cell = np.nonzero(probes(codes[s], model))
        yield q + s.start, cell


def short_list(index: DataFrame, queries: DataFrame, model: Model, size: int) -> DataFrame:
    """query_id, id, rank of the ``size`` rows in a query's cells whose codes fit best."""
    asked = queries.where(F.col("vector").isNotNull()).select(
        "query_id", byte_codes(F.col("vector")).alias("code")
    )

    def prepare(q: dict[str, list]) -> tuple[np.ndarray, np.ndarray]:
        # All queries of a block are held at once: a bit for each query and cell.
        codes = _unpacked(pa.array(q["code"], pa.binary()))
        return codes, np.packbits(probes(codes, model), axis=0)

    def scorer(part: pa.Table, prepared: Any) -> np.ndarray:
        codes, probed = prepared
        rows = part.column("code").combine_chunks()
        cell = part.column("cell").to_numpy()
        out = np.full((len(cell), len(codes)), -np.inf)
        # Rows come ordered by cell: each run of a cell meets the queries that look into it.
        starts = np.flatnonzero(np.diff(cell, prepend=-1))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(cell)]):
            asking = np.flatnonzero(np.unpackbits(probed[:, cell[a]], count=len(codes)))
            if len(asking):
                out[a:b, asking] = _unpacked(rows.slice(a, b - a)) @ codes[asking].T
        return out

    return blocked_top_k(
        index.select("id", "cell", "code"),
        _blocks(asked, lambda r: 96 + 2 * len(r["code"]), QUERY_BYTES),
        _type(queries, "query_id"),
        size,
        prepare,
        scorer,
        lambda p: len(p[0]),
    )


def _type(df: DataFrame, column: str) -> DataType:
    return df.schema[column].dataType


def cell_search(
    index: DataFrame, queries: DataFrame, model: Model, k: int = 10, metric: str = "cosine", short: int = SHORT
) -> DataFrame:
    """Best ``k`` rows of each query's cells: ``short * k`` by their codes, then by the vectors.

    ``index`` is what :func:`build` returns, ``queries`` has query_id and
    vector.  Queries without a vector and an empty index give no hits.
    """
    few = short_list(index, queries, model, short * k).select("query_id", "id", "rank")
    asked = queries.select("query_id", F.col("vector").alias("_asked"))
    scored = (
        attach(few, index.select("id", "vector"), queries.count(), short * k)
        .join(asked, "query_id")
        .select(
            "query_id",
            "id",
            F.round(similarity_column(F.col("vector"), F.col("_asked"), metric), SCORE_DIGITS).alias("score"),
        )
    )
    return top_k(scored, ["query_id"], [F.desc("score"), F.col("id")], k)


def rows_met(index: DataFrame, queries: DataFrame, model: Model) -> DataFrame:
    """(query_id, cells, rows): the cells a query looks into, and the rows in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, cell in cells_probed(_unpacked(batch.column("code")), model):
                yield pa.record_batch(
                    [batch.column("query_id").take(pa.array(q)), pa.array(cell.astype(np.int32))],
                    names=["query_id", "cell"],
                )

    coded = queries.where(F.col("vector").isNotNull()).select(
        "query_id", byte_codes(F.col("vector")).alias("code")
    )
    kind = _type(queries, "query_id").simpleString()
    looked = coded.mapInArrow(run, f"query_id {kind}, cell int")
    # One row per cell, and there are at most MOST_CELLS.
    sizes = index.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"))
    return (
        looked.join(F.broadcast(sizes), "cell")
        .groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("cells"), F.sum("rows").alias("rows"))
    )
