"""Concatenate tokenised documents and cut the stream into fixed windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.prefix import PART, partition_bases
from casewright.llm.tokens import SLICE_BYTES, crc32, encoder, tokenizer_path
from casewright.llm.words import release_memory, slices
from casewright.session import shared_folder

WINDOW = 1024

TOKEN_ROWS = f"doc_id long, {PART} int, before long, n_tokens long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def narrow(ids: bytes) -> bytes:
    """Ids below 65,536 in two bytes each, others in four; the length tells which is which."""
    values = np.frombuffer(ids, "<u4")
    return values.astype("<u2").tobytes() if not len(values) or values.max() < 65536 else ids


def widen(ids: bytes, count: int) -> bytes:
    return ids if len(ids) == 4 * count else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def store_tokens(documents: DataFrame, folder: str, path: str) -> DataFrame:
    """First pass: ids of every document, with the ids before it in its partition.

    The table is written, so the texts are tokenised once, and partition
    numbers and running offsets stay fixed even if executors are lost later.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), (PART, pa.int32()), ("before", pa.int64()),
         ("n_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, total = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in slices(batch, "text", SLICE_BYTES):
                ids = tokens.encode(piece.column("text"))
                counts = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
                ends = total + np.cumsum(counts)
                yield pa.record_batch(
                    [
                        piece.column("doc_id"),
                        pa.array(np.full(len(ids), part, np.int32)),
                        pa.array(ends - counts),
                        pa.array(counts),
                        pa.array([narrow(x) for x in ids], pa.binary()),
                    ],
                    schema=schema,
                )
                total = int(ends[-1])
        release_memory()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    rows.mapInArrow(run, TOKEN_ROWS).write.option("compression", "zstd").parquet(folder)
    return documents.sparkSession.read.parquet(folder)


def pack(documents: DataFrame, window: int = WINDOW, path: str | None = None) -> DataFrame:
    """Pieces of all documents in sequences of ``window`` ids.

    The documents' ids, each with an end id, are laid end to end.  Totals per
    partition give every partition, and so every document, a global offset;
    cutting at multiples of ``window`` then needs no other row.  A piece is
    the boundary record of a document inside one sequence: where it starts in
    the document and in the sequence, and how long it is.  All sequences but
    the last are full.  No row is shuffled; only one total per partition is.

    A null or empty text has the end id alone; equal rows are packed one by
    one; an empty table gives no pieces; other columns are not looked at.
    """
    spark = documents.sparkSession
    stored = store_tokens(documents, shared_folder(spark, "packing"), path or tokenizer_path())
    bases = partition_bases(stored, {"tokens": F.col("n_tokens")})
    placed = stored.join(F.broadcast(bases), PART).select(
        "doc_id", (F.col("tokens_base") + F.col("before")).alias("at"), "n_tokens", "ids"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "ids", SLICE_BYTES):
                yield pieces_of(piece, window)

    return placed.mapInArrow(cut, PIECES)


def pieces_of(batch: pa.RecordBatch, window: int) -> pa.RecordBatch:
    at = batch.column("at").to_numpy()
    count = batch.column("n_tokens").to_numpy()
    ids = [widen(x, n) for x, n in zip(batch.column("ids").to_pylist(), count.tolist())]
    first = at // window
    pieces = (at + count - 1) // window - first + 1
    row = np.repeat(np.arange(len(at)), pieces)
    number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    sequence = first[row] + number
    begin = np.maximum(sequence * window, at[row])
    end = np.minimum((sequence + 1) * window, (at + count)[row])
    start = begin - at[row]
    crc = [
        crc32(memoryview(ids[r])[4 * a : 4 * b])
        for r, a, b in zip(row.tolist(), start.tolist(), (end - at[row]).tolist())
    ]
    doc_id = batch.column("doc_id").take(pa.array(row))
    return pa.record_batch(
        [doc_id, pa.array(start), pa.array(end - begin), pa.array(crc, pa.int64()),
         pa.array(count[row]), pa.array(sequence), pa.array(begin - sequence * window)],
        names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    )
