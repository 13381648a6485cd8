"""Removal of long word sequences that occur more than once in a collection.

A compressed FM-index of a whole collection does not fit a task, and streaming
every document through the index of every shard would cost the square of the
input.  Shards are therefore cut by content: every window of ``window`` words
belongs to its anchor, the word n-gram of least hash in it, and equal windows
have equal anchors.  Anchors that occur once cannot be part of a repeat and
are dropped; the others send the words around them to the shard of their hash.
A shard builds the FM-index of what it got and streams the same passages
through it: backward search over the wavelet tree gives matching statistics,
and the intervals of windows found twice or more are reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.fm_index import FMIndex
from casewright.llm.words import (
    SLICE_BYTES,
    gram_hashes,
    map_slices,
    mixed,
    raw,
    slices,
    word_hashes,
    words_of,
)

WINDOW = 35
GRAM = 8
# Bytes of a word's hash that travel with a passage.
WORD_BYTES = 6
# Words one FM-index should hold.
SHARD_WORDS = 1 << 20
# Anchors with more passages are spread by the words all windows of a quarter share.
HOT_PASSAGES = 2000
QUARTER = 4


class Passages(NamedTuple):
    """Runs of windows with one anchor: first window (word index), number, anchor, text."""

    first: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    text: np.ndarray


def passages(hashes: np.ndarray, firsts: np.ndarray, window: int, gram: int) -> Passages:
    """Cut all windows of some texts into runs with the same anchor position."""
    grams = gram_hashes(hashes, gram)
    span = window - gram + 1
    none = np.empty(0, np.int64)
    if len(grams) < span:
        return Passages(none, none, np.empty(0, np.uint64), none)
    least, width = np.arange(len(grams)), 1

    def lower(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(grams[a] <= grams[b], a, b)

    while 2 * width <= span:
        least = lower(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = lower(least[: len(grams) - span + 1], least[span - width :])
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))[: len(least)]
    start = np.flatnonzero(np.arange(len(least)) + window <= firsts[1:][text])
    if not len(start):
        return Passages(none, none, np.empty(0, np.uint64), none)
    least, text = least[start], text[start]
    new = np.ones(len(start), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    return Passages(start[begin], np.diff(np.append(begin, len(start))), grams[least[begin]], text[begin])


def unique_texts(documents: DataFrame) -> DataFrame:
    """text_id, text and copies of every different text; null counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.unhex(F.md5(text)).alias("text_id"), text.alias("text"))
    # Joins on the id add this filter; with it everywhere, all readers share one shuffle of the texts.
    known = rows.where(F.col("text_id").isNotNull())
    return known.groupBy("text_id").agg(F.first("text").alias("text"), F.count("*").alias("copies"))


def _cut(batch: pa.RecordBatch, window: int, gram: int):
    data, offsets = raw(batch.column("text"))
    w = words_of(data, offsets)
    hashes = word_hashes(w)
    return w, hashes, passages(hashes, w.first, window, gram)


def _anchors(texts: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w, _, p = _cut(batch, window, gram)
        where = pa.array(p.text)
        return pa.record_batch(
            [
                pa.array(p.anchor.view(np.int64)),
                batch.column("text_id").take(where),
                pa.array((p.first - w.first[p.text]).astype(np.int32)),
                batch.column("copies").take(where),
            ],
            names=["anchor", "text_id", "first", "copies"],
        )

    return map_slices(texts, run, "anchor long, text_id binary, first int, copies long")


def _routed(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """The words around repeated anchors, with the key of their shard."""
    schema = pa.schema(
        [("shard", pa.int64()), ("text_id", pa.binary()), ("first", pa.int32()), ("copies", pa.int64()),
         ("words", pa.binary())]
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w, hashes, p = _cut(batch, window, gram)
        marks = batch.column("marks")
        own = np.repeat(np.arange(len(marks)), marks.value_lengths().to_numpy())
        flat = marks.flatten()
        firsts = flat.field("first").to_numpy().astype(np.int64) + w.first[own]
        index = np.searchsorted(p.first, firsts)
        first, count, key = p.first[index], p.count[index], p.anchor[index]
        hot = flat.field("hot").to_numpy(zero_copy_only=False)
        if hot.any():
            first, count, key, own = _quarters(hashes, first, count, key, own, hot, window, gram)
        packed = hashes.view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES].tobytes()
        words = [
            packed[WORD_BYTES * a : WORD_BYTES * b]
            for a, b in zip(first.tolist(), (first + count + window - 1).tolist())
        ]
        where = pa.array(own)
        return pa.record_batch(
            [
                pa.array(key.view(np.int64)),
                batch.column("text_id").take(where),
                pa.array((first - w.first[own]).astype(np.int32)),
                batch.column("copies").take(where),
                pa.array(words, pa.binary()),
            ],
            schema=schema,
        )

    return map_slices(texts, run, "shard long, text_id binary, first int, copies long, words binary")


def _quarters(hashes, first, count, key, own, hot, window, gram):
    """Cut runs of hot anchors at fixed distances from the anchor and rename their shards.

    The windows of one piece share all words but ``QUARTER - 1`` at each end;
    equal windows lie in the same piece of their runs, so its shared words
    make a key that keeps them together and parts what only has the anchor in
    common.
    """
    out = [(first[~hot], count[~hot], key[~hot], own[~hot])]
    first, count, key, own = first[hot], count[hot], key[hot], own[hot]
    # The anchor is the first of its kind in every window of the run, so it fixes the grid.
    grams = gram_hashes(hashes, gram)
    span = window - gram + 1
    offset = np.zeros(len(first), np.int64)
    todo = np.arange(len(first))
    for k in range(span):
        same = grams[first[todo] + k] == key[todo]
        offset[todo[same]] = k
        todo = todo[~same]
    anchor = first + offset
    core = gram_hashes(hashes, window - QUARTER + 1)
    for piece in range(-(-span // QUARTER)):
        # Windows that start QUARTER * piece .. + QUARTER - 1 words before the anchor.
        low = np.maximum(first, anchor - QUARTER * piece - QUARTER + 1)
        high = np.minimum(first + count, anchor - QUARTER * piece + 1)
        some = np.flatnonzero(low < high)
        shared = core[anchor[some] - QUARTER * piece] if len(some) else core[:0]
        name = mixed(shared ^ mixed(key[some] + np.uint64(piece)))
        out.append((low[some], (high - low)[some], name, own[some]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _search(routed: DataFrame, window: int) -> DataFrame:
    """Build the FM-index of every shard and report the repeated intervals of its passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(window)
        for batch in batches:
            for piece in slices(batch, "words", SLICE_BYTES):
                for part in _by_key(piece):
                    if shard.words > SHARD_WORDS and part.column("shard")[0].as_py() != shard.last:
                        yield from shard.report()
                        shard = Shard(window)
                    shard.add(part)
        yield from shard.report()

    sorted_ = routed.repartition("shard").sortWithinPartitions("shard")
    return sorted_.mapInArrow(run, "text_id binary, start int, end int")


def _by_key(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut a batch sorted by shard key into one piece before its last key and one for that key."""
    keys = batch.column("shard").to_numpy()
    edge = int(np.searchsorted(keys == keys[-1], True))
    if edge:
        yield batch.slice(0, edge)
    yield batch.slice(edge)


class Shard:
    """Passages of some shard keys: different ones once, with the places that have them."""

    def __init__(self, window: int):
        self.window = window
        self.known: dict[bytes, int] = {}
        self.weights: list[int] = []
        self.places: list[pa.RecordBatch] = []
        self.which: list[int] = []
        self.words = 0
        self.last: int | None = None

    def add(self, batch: pa.RecordBatch) -> None:
        for words, copies in zip(batch.column("words").to_pylist(), batch.column("copies").to_pylist()):
            index = self.known.get(words)
            if index is None:
                index = self.known[words] = len(self.weights)
                self.weights.append(0)
                self.words += len(words) // WORD_BYTES
            self.weights[index] += copies
            self.which.append(index)
        self.places.append(batch.select(["text_id", "first"]))
        self.last = batch.column("shard")[-1].as_py()

    def report(self) -> Iterator[pa.RecordBatch]:
        if not self.known:
            return
        sizes = np.fromiter((len(p) // WORD_BYTES for p in self.known), np.int64, len(self.known))
        hashes = np.zeros((int(sizes.sum()), 8), np.uint8)
        hashes[:, :WORD_BYTES] = np.frombuffer(b"".join(self.known), np.uint8).reshape(-1, WORD_BYTES)
        _, codes = np.unique(hashes.view("<u8")[:, 0], return_inverse=True)
        # One 0 after every passage.
        starts = np.cumsum(sizes + 1) - sizes - 1
        text = np.zeros(int((sizes + 1).sum()), np.int64)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        text[np.arange(len(codes)) + owner] = codes + 1
        weights = np.repeat(np.asarray(self.weights, np.int64), sizes + 1)
        index = FMIndex(text, weights, int(sizes.max()))
        found, first, last = index.repeated_windows(text, starts, sizes - self.window + 1, self.window)
        order = np.argsort(found, kind="stable")
        found, first, last = found[order], first[order], last[order]
        bounds = np.searchsorted(found, np.arange(len(sizes) + 1))
        done = 0
        for places in self.places:
            which = np.asarray(self.which[done : done + places.num_rows])
            done += places.num_rows
            count = bounds[which + 1] - bounds[which]
            row = np.repeat(np.arange(len(which)), count)
            at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + bounds[which][row]
            base = places.column("first").to_numpy().astype(np.int64)[row]
            yield pa.record_batch(
                [
                    places.column("text_id").take(pa.array(row)),
                    pa.array((base + first[at]).astype(np.int32)),
                    pa.array((base + last[at] + self.window).astype(np.int32)),
                ],
                names=["text_id", "start", "end"],
            )


def repeated_intervals(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Word intervals of different texts in which every window occurs twice or more.

    ``texts`` comes from :func:`unique_texts`; a text with copies counts as
    often as it occurs.  Intervals of a text may touch or overlap.
    """
    anchors = _anchors(texts, window, gram)
    repeated = (
        anchors.groupBy("anchor")
        .agg(F.sum("copies").alias("copies"), F.count("*").alias("passages"))
        .where("copies > 1")
        .select("anchor", (F.col("passages") > HOT_PASSAGES).alias("hot"))
    )
    marks = (
        anchors.select("anchor", "text_id", "first")
        .join(repeated, "anchor")
        .groupBy("text_id")
        .agg(F.collect_list(F.struct("first", "hot")).alias("marks"))
    )
    return _search(_routed(texts.join(marks, "text_id"), window, gram), window)


def kept_texts(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """text_id, n_words, n_removed, kept text and removed intervals of different texts.

    Every word in a repeated interval is removed, judged on the input; the
    words that are left are joined by one space.
    """
    intervals = (
        repeated_intervals(texts, window, gram)
        .groupBy("text_id")
        .agg(F.collect_set(F.struct("start", "end")).alias("repeats"))
    )
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema(
        [("text_id", pa.binary()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
         ("kept", pa.string()), ("removed", span)]
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [
            _without(t, r)
            for t, r in zip(
                batch.column("text").cast(pa.binary()).to_pylist(), batch.column("repeats").to_pylist()
            )
        ]
        columns = list(zip(*rows))
        arrays = [pa.array(c, schema.field(k + 1).type) for k, c in enumerate(columns)]
        return pa.record_batch([batch.column("text_id"), *arrays], schema=schema)

    joined = texts.join(intervals, "text_id", "left")
    return map_slices(
        joined,
        run,
        "text_id binary, n_words long, n_removed long, kept string, removed array<struct<start:int,end:int>>",
    )


def _without(text: bytes, repeats: list[dict] | None):
    words = text.split()
    merged: list[dict] = []
    for r in sorted(repeats or (), key=lambda r: r["start"]):
        if merged and r["start"] <= merged[-1]["end"]:
            merged[-1]["end"] = max(merged[-1]["end"], r["end"])
        else:
            merged.append(dict(r))
    kept, at = [], 0
    for r in merged:
        kept += words[at : r["start"]]
        at = r["end"]
    kept += words[at:]
    return len(words), len(words) - len(kept), b" ".join(kept).decode(), merged


def of_documents(documents: DataFrame, per_text: DataFrame) -> DataFrame:
    """Give every document the result of its text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id"), F.unhex(F.md5(text)).alias("text_id"))
    return rows.join(per_text, "text_id").drop("text_id")


def remove_repeats(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept and removed intervals of every document.

    A null text counts as empty and has no words; a text shorter than a window
    loses nothing; rows that repeat a document are occurrences like any other;
    an empty table gives no rows; other columns are not looked at.
    """
    return of_documents(documents, kept_texts(unique_texts(documents), window, gram))
