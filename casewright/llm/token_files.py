"""Token-id files: documents in ascending order of their ids, entropy coded in sections.

The files are Parquet, written and committed by Spark.  A row is a section of
some two million ids: the documents in it, one frequency table, and blocks
that are coded independently with that table (see :mod:`casewright.llm.rans`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright.llm.packing import store_tokens, widen
from casewright.llm.prefix import PART, partition_bases
from casewright.llm.rans import Block, Coder, Table, table_of
from casewright.llm.tokens import SLICE_BYTES, encoder, tokenizer_path
from casewright.llm.words import release_memory, rows_per_batch, slices
from casewright.session import shared_folder

BLOCK_IDS = 1 << 19
SECTION_IDS = 1 << 21
# Documents that pass between Spark and a worker at once; their buffers lie outside the heap.
BATCH_ROWS = 500

BLOCK = pa.struct(
    [("count", pa.int32()), ("lanes", pa.int32()), ("crc", pa.int64()), ("words", pa.binary()),
     ("states", pa.binary()), ("offsets", pa.list_(pa.int64()))]
)
SECTION = pa.schema(
    [(PART, pa.int32()), ("section", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()),
     ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
     ("symbols", pa.binary()), ("shares", pa.binary()), ("blocks", pa.list_(BLOCK))]
)
SECTION_DDL = (
    f"{PART} int, section int, before long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
    "symbols binary, shares binary, blocks array<struct<count:int,lanes:int,crc:long,words:binary,"
    "states:binary,offsets:array<long>>>"
)


def write_tokens(documents: DataFrame, folder: str, path: str | None = None) -> None:
    """Tokenise all whole texts and write them in ascending order of doc_id.

    Two jobs: texts are encoded where they lie, and their ids, two bytes each,
    are stored; then the ids are dealt out by ranges of doc_id and coded.  So
    no task holds texts, the encoder's store and a coder's arrays at once.

    File order is document order; rows with one doc_id are ordered by their
    ids.  Null ids come first, a null text counts as empty and has the end id
    alone, an empty table gives no sections, and other columns are not looked
    at.  A task holds one section, or one document if that is longer.
    """
    spark = documents.sparkSession
    with rows_per_batch(spark, BATCH_ROWS):
        stored = store_tokens(documents, shared_folder(spark, "token-ids"), path or tokenizer_path())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder.cache_clear()
        release_memory()
        part = TaskContext.get().partitionId()
        section, before, held = 0, 0, 0
        docs: list[int | None] = []
        texts: list[bytes] = []
        for batch in batches:
            for piece in slices(batch, "ids", SLICE_BYTES):
                columns = (piece.column(c).to_pylist() for c in ("doc_id", "n_tokens", "ids"))
                for doc, count, ids in zip(*columns):
                    if held and held + count > SECTION_IDS:
                        yield section_of(part, section, before, docs, texts)
                        section, before, held, docs, texts = section + 1, before + held, 0, [], []
                    docs.append(doc)
                    texts.append(widen(ids, count))
                    held += count
        if docs:
            yield section_of(part, section, before, docs, texts)
        del docs, texts
        release_memory()

    rows = stored.select("doc_id", "n_tokens", "ids")
    ranged = rows.repartitionByRange(F.col("doc_id"), F.xxhash64("ids"))
    sections = ranged.sortWithinPartitions("doc_id", "ids").mapInArrow(run, SECTION_DDL)
    with rows_per_batch(spark, BATCH_ROWS):
        sections.write.parquet(folder)


def section_of(
    part: int, section: int, before: int, docs: list[int | None], texts: list[bytes]
) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(texts), "<u4")
    table = table_of(ids)
    coder = Coder(table)
    blocks = []
    for at in range(0, len(ids), BLOCK_IDS):
        b = coder.encode(ids[at : at + BLOCK_IDS])
        blocks.append(
            {"count": b.count, "lanes": b.lanes, "crc": b.crc, "words": b.words.astype("<u4").tobytes(),
             "states": b.states.astype("<u8").tobytes(), "offsets": b.offsets.tolist()}
        )
    row = [part, section, before, len(ids), docs, [len(t) // 4 for t in texts],
           table.symbols.astype("<u4").tobytes(), table.shares.astype("<u4").tobytes(), blocks]
    return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, SECTION)], schema=SECTION)


def decode_section(row: dict) -> bytes:
    """All ids of a section as little-endian unsigned 32-bit integers."""
    shares = np.frombuffer(row["shares"], "<u4").astype(np.int64)
    coder = Coder(Table(np.frombuffer(row["symbols"], "<u4"), shares))
    slots = coder.slots()
    out = []
    for b in row["blocks"]:
        block = Block(
            b["count"],
            b["lanes"],
            b["crc"],
            np.frombuffer(b["words"], "<u4"),
            np.frombuffer(b["states"], "<u8").reshape(-1, b["lanes"]),
            np.asarray(b["offsets"], np.int64),
        )
        out.append(coder.decode(block, slots).astype("<u4").tobytes())
    return b"".join(out)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids of every document of the files.

    ``start`` counts the ids of all documents before it: totals per partition
    give each a base, sections and documents inside count on from there.
    """
    stored = spark.read.schema(SECTION_DDL).parquet(folder)
    bases = partition_bases(stored, {"tokens": F.col("n_tokens")})
    placed = stored.join(F.broadcast(bases), PART)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder.cache_clear()
        release_memory()
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ids = memoryview(decode_section(row))
                counts = np.asarray(row["doc_tokens"], np.int64)
                ends = np.cumsum(counts)
                starts = ends - counts
                for a in range(0, len(counts), BATCH_ROWS):
                    some = slice(a, a + BATCH_ROWS)
                    yield pa.record_batch(
                        [
                            pa.array(row["doc_ids"][some], pa.int64()),
                            pa.array(starts[some] + row["before"] + row["tokens_base"]),
                            pa.array(counts[some]),
                            pa.array(
                                [ids[4 * x : 4 * y] for x, y in zip(starts[some].tolist(), ends[some].tolist())],
                                pa.binary(),
                            ),
                        ],
                        schema=schema,
                    )
                del row, ids
        release_memory()

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
