"""Words of whole texts as arrays: the shared arithmetic of the text operators.

A word is a run of bytes other than space and 0x09-0x0D.  In UTF-8 no other
character contains these bytes, so words of the bytes are words of the text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Text handled at once inside a task; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece has at most ``limit`` bytes of text, or one row."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def release_memory() -> None:
    """Give freed memory back to the system; a worker outlives its tasks."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


@contextmanager
def rows_per_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Let jobs that run inside send so many rows at once to Python workers."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def map_slices(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str | StructType,
    column: str = "text",
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Apply ``function`` to slices of bounded text size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, column, limit):
                out = function(piece)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words(NamedTuple):
    """All words of some texts; ``first[i] : first[i + 1]`` are those of text ``i``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(data)
    if not n:
        none = np.empty(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64))
    inside = ~SPACE[data]
    before = np.empty(n, bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.empty(n, bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


# Polynomial hashing modulo 2**64; the byte values and factors come from fixed seeds.
_BYTES = np.random.default_rng(35).integers(0, 2**64, 256, np.uint64, endpoint=False)
_BYTE_FACTOR = 0x9E3779B97F4A7C15
_WORD_FACTOR = 0xC2B2AE3D27D4EB4F


_kept_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(factor: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a factor and of its inverse, kept up to the usual size of a slice."""
    kept = _kept_powers.get(factor)
    if kept is None or len(kept[0]) < size:
        size = 1 << max(12, size.bit_length())
        out = []
        for f in (factor, pow(factor, -1, 2**64)):
            steps = np.full(size, f, np.uint64)
            steps[0] = 1
            out.append(np.cumprod(steps, dtype=np.uint64))
        kept = out[0], out[1]
        if size <= 2 * SLICE_BYTES:
            _kept_powers[factor] = kept
    return kept


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, factor: int) -> np.ndarray:
    """Position-free polynomial hash of the spans ``[start, end)`` of ``values``."""
    power, inverse = _powers(factor, len(values))
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=prefix[1:])
    return mixed((prefix[ends] - prefix[starts]) * inverse[starts])


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_hashes(w: Words) -> np.ndarray:
    """64-bit hash of every word."""
    return _sums(_BYTES[w.data], w.starts, w.ends, _BYTE_FACTOR)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of byte spans."""
    return _sums(_BYTES[data], starts, ends, _BYTE_FACTOR)


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every ``size`` consecutive words, text borders ignored."""
    count = max(0, len(hashes) - size + 1)
    starts = np.arange(count)
    return _sums(hashes, starts, starts + size, _WORD_FACTOR)


def text_of_words(w: Words) -> np.ndarray:
    """The text each word belongs to."""
    return np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
