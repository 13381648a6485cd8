"""Passages of test items in documents: rare word pairs as seeds, then Smith-Waterman alignment.

Words are compared in lower case without signs.  A seed is a two-word gram of
a test item, of neighbours or with one word between them; in a document up to
two words may stand between the two, so copies with words changed, left out or
put in at every second or third place still hold seeds.  Seeds are chosen rare
first: their document frequencies are counted over all documents, and grams
that no document has, which are those broken in a copy, are none.  Where two
seeds of an item meet near one diagonal, the document is aligned with the item
around them; the alignment score, as a fraction of the score of a verbatim
copy, finds edited copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.words import map_slices, mixed, raw, text_of_words, word_hashes, words_of

# Distances between the two words of a gram, in an item and in a document.
ITEM_STEPS = (1, 2)
DOCUMENT_STEPS = (1, 2, 3)
# Grams that at most this share of the documents has are seeds, and of each item so many of the rarest.
RARE_SHARE = 0.001
LEAST_SEEDS = 24
# Seeds near one diagonal before an alignment.
TOGETHER = 2
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SCORE = 0.5
# Test text that travels to the tasks at once; a larger set goes in blocks of this size.
BLOCK_BYTES = 4 << 20
# Cells of one batch of alignments.
CELLS = 1 << 21

_NORMAL = np.arange(256, dtype=np.uint8)
_NORMAL[:128] = [c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(128)]

MATCHES = "doc_id long, item_id long, score double, start long, end long, n_seeds long"


class Items(NamedTuple):
    """Test items of a block: ids, word codes of all, where each begins, their grams."""

    ids: np.ndarray
    words: np.ndarray
    first: np.ndarray
    grams: np.ndarray
    item: np.ndarray
    position: np.ndarray


def _codes(column: pa.Array):
    data, offsets = raw(column)
    w = words_of(_NORMAL[data], offsets)
    return word_hashes(w), w


def _grams(hashes: np.ndarray, text: np.ndarray, steps: tuple[int, ...]):
    """Hash and first word of every two words of one text that lie one of ``steps`` apart."""
    grams, places = [], []
    for step in steps:
        at = np.flatnonzero(text[:-step] == text[step:]) if len(text) > step else np.empty(0, np.int64)
        grams.append(mixed(hashes[at] * np.uint64(0x9E3779B97F4A7C15) + hashes[at + step]))
        places.append(at)
    return np.concatenate(grams), np.concatenate(places)


def item_blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[Items]:
    """Test items in blocks of at most ``limit`` bytes of text, or one item."""

    def block(rows: list) -> Items:
        hashes, w = _codes(pa.array([r[1] for r in rows], pa.string()))
        text = text_of_words(w)
        grams, place = _grams(hashes, text, ITEM_STEPS)
        item = text[place]
        return Items(np.array([r[0] for r in rows], np.int64), hashes, w.first, grams, item, place - w.first[item])

    rows, held = [], 0
    chosen = benchmark.select(F.col("item_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    for r in chosen.where("item_id IS NOT NULL").toLocalIterator():
        rows.append(r)
        held += len(r[1].encode())
        if held >= limit:
            yield block(rows)
            rows, held = [], 0
    if rows:
        yield block(rows)


class Lookup:
    """Finds grams among sorted keys; most others are ruled out by a table of their first bits."""

    BITS = 20

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.first = np.zeros(1 << self.BITS, bool)
        self.first[(keys >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Grams that are keys, and the range of keys that equal each."""
        some = np.flatnonzero(self.first[(grams >> np.uint64(64 - self.BITS)).astype(np.int64)])
        low = np.searchsorted(self.keys, grams[some], "left")
        high = np.searchsorted(self.keys, grams[some], "right")
        hit = high > low
        return some[hit], low[hit], high[hit]


def document_frequencies(documents: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """For every gram of the block the number of documents that have it, and the number of documents.

    Counted in one pass: tasks send sums for the grams of the block alone.
    """
    keys, which = np.unique(items.grams, return_inverse=True)
    lookup = Lookup(keys)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, w = _codes(batch.column("text"))
        text = text_of_words(w)
        grams, place = _grams(hashes, text, DOCUMENT_STEPS)
        hit, key, _ = lookup.find(grams)
        pairs = np.unique(key * batch.num_rows + text[place[hit]])
        counts = np.bincount(pairs // max(1, batch.num_rows), minlength=len(keys))
        at = np.flatnonzero(counts)
        return pa.record_batch(
            [pa.array(np.append(at, -1)), pa.array(np.append(counts[at], batch.num_rows))], names=["key", "n"]
        )

    texts = documents.select(F.col("text").cast("string").alias("text"))
    # At most one row per gram of the block.
    rows = map_slices(texts, run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()
    counts = {r.key: r.n for r in rows}
    found = np.array([counts.get(k, 0) for k in range(len(keys))], np.int64)
    return (found[which] if len(which) else found), counts.get(-1, 0)


def chosen_seeds(items: Items, frequency: np.ndarray, documents: int) -> np.ndarray:
    """Rows of ``items.grams`` that are seeds, in the order of their hashes.

    Those that some document has and few have, and of every item the
    ``LEAST_SEEDS`` rarest that some document has.
    """
    there = np.flatnonzero(frequency > 0)
    order = there[np.lexsort((items.position[there], frequency[there], items.item[there]))]
    item = items.item[order]
    number = np.arange(len(order)) - np.searchsorted(item, item, "left")
    kept = order[(number < LEAST_SEEDS) | (frequency[order] <= RARE_SHARE * documents)]
    return kept[np.argsort(items.grams[kept], kind="stable")]


def align(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment scores of pairs of rows, and where in ``b`` they end (exclusive).

    Smith-Waterman with a constant price per gap, row by row for all pairs: a
    gap along the row is a running maximum.  0 in ``a`` or ``b`` is padding.
    """
    rows, width = b.shape
    slope = -GAP * np.arange(width + 1, dtype=np.int32)
    last = np.zeros((rows, width + 1), np.int32)
    best = np.zeros(rows, np.int32)
    end = np.zeros(rows, np.int64)
    for i in range(a.shape[1]):
        same = (a[:, i, None] == b) & (b != 0)
        now = np.zeros_like(last)
        now[:, 1:] = np.maximum(last[:, :-1] + np.where(same, MATCH, MISMATCH), last[:, 1:] + GAP)
        np.maximum(now, 0, out=now)
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        now[a[:, i] == 0] = 0
        at = now.argmax(axis=1)
        high = now[np.arange(rows), at]
        end = np.where(high > best, at, end)
        best = np.maximum(best, high)
        last = now
    return best, end


def _regions(text: np.ndarray, item: np.ndarray, begin: np.ndarray, length: np.ndarray):
    """Join seed hits of one text and item whose implied item starts are near each other."""
    order = np.lexsort((begin, item, text))
    text, item, begin = text[order], item[order], begin[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (begin[1:] - begin[:-1] > length[item[1:]] // 2 + 1)
    at = np.flatnonzero(new)
    stop = np.append(at[1:], len(text))[: len(at)] - 1
    return text[at], item[at], begin[at], begin[stop], np.diff(np.append(at, len(text)))


def search_batch(batch: pa.RecordBatch, items: Items, seeds: np.ndarray, lookup: Lookup, least: float) -> pa.RecordBatch:
    """Passages of the batch's documents; ``lookup`` finds the grams of ``seeds``."""
    hashes, w = _codes(batch.column("text"))
    first = w.first
    text_of = text_of_words(w)
    grams, place = _grams(hashes, text_of, DOCUMENT_STEPS)
    hit, low, high = lookup.find(grams)
    count = high - low
    row = np.repeat(place[hit], count)
    seed = seeds[np.repeat(low - np.cumsum(count) + count, count) + np.arange(len(row))]
    length = np.diff(items.first)
    text, item, begin, last, n_seeds = _regions(
        text_of[row], items.item[seed], row - first[text_of[row]] - items.position[seed], length
    )
    # Items with one seed alone have to do with it.
    enough = n_seeds >= np.minimum(TOGETHER, np.bincount(items.item[seeds], minlength=len(items.ids)))[item]
    text, item, begin, last, n_seeds = (x[enough] for x in (text, item, begin, last, n_seeds))
    slack = length[item] // 3 + 2
    size_of = np.diff(first)
    start = np.maximum(0, begin - slack)
    stop = np.minimum(size_of[text], last + length[item] + slack)
    score, begins, ends = np.zeros(len(text)), start.copy(), stop.copy()
    order = np.argsort((stop - start) * length[item], kind="stable")
    at = 0
    while at < len(order):
        # Similar sizes share a batch, so that little of it is padding.
        take, wide, tall = at, 0, 0
        while take < len(order):
            k = order[take]
            w, t = max(wide, stop[k] - start[k]), max(tall, length[item[k]])
            if take > at and w * (take - at + 1) > CELLS // 16:
                break
            wide, tall, take = w, t, take + 1
        some = order[at:take]
        at = take
        a = np.zeros((len(some), tall), np.uint64)
        b = np.zeros((len(some), wide), np.uint64)
        for r, k in enumerate(some.tolist()):
            x = items.words[items.first[item[k]] : items.first[item[k] + 1]]
            y = hashes[first[text[k]] + start[k] : first[text[k]] + stop[k]]
            a[r, : len(x)], b[r, : len(y)] = x | np.uint64(1), y | np.uint64(1)
        best, end = align(a, b)
        score[some] = best / (MATCH * length[item[some]])
        ends[some] = start[some] + end
        good = np.flatnonzero(score[some] >= least)
        if len(good):
            _, back = align(a[good, ::-1], b[good, ::-1])
            begins[some[good]] = start[some[good]] + wide - back
    keep = np.flatnonzero(score >= least)
    return pa.record_batch(
        [
            batch.column("doc_id").take(pa.array(text[keep])),
            pa.array(items.ids[item[keep]]),
            pa.array(score[keep]),
            pa.array(begins[keep]),
            pa.array(ends[keep]),
            pa.array(n_seeds[keep]),
        ],
        names=["doc_id", "item_id", "score", "start", "end", "n_seeds"],
    )


def _searches(documents: DataFrame, benchmark: DataFrame) -> Iterator[tuple[Items, np.ndarray, Lookup]]:
    """Blocks of items with their seeds, each after a count over all documents."""
    for items in item_blocks(benchmark):
        frequency, n = document_frequencies(documents, items)
        seeds = chosen_seeds(items, frequency, n)
        if len(seeds):
            yield items, seeds, Lookup(items.grams[seeds])


def contaminated_passages(
    documents: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE
) -> DataFrame:
    """doc_id, item_id, score, start, end and n_seeds of every passage that copies a test item.

    ``start`` and ``end`` count words of the normalised text.  Items travel to
    the tasks in blocks of bounded size, and every block meets all documents
    twice, for the frequencies and for the search; no text is shuffled.  Null
    and empty texts, and items of one word, match nothing; equal rows give
    equal matches; an empty table on either side gives no rows; other columns
    are not looked at.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    out = documents.sparkSession.createDataFrame([], MATCHES)
    for search in _searches(documents, benchmark):
        out = out.unionByName(map_slices(rows, lambda b, s=search: search_batch(b, *s, least), MATCHES))
    return out


def clean_documents(documents: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The documents without a passage of a test item, with all their columns.

    The rows are judged where they are, so no text is shuffled.  Null and
    empty texts stay, equal rows have equal fates, and an empty table gives no
    rows.
    """
    kept = documents
    for search in _searches(documents, benchmark):

        def keep(batch: pa.RecordBatch, search=search) -> pa.RecordBatch:
            rows = pa.record_batch(
                [pa.array(np.arange(batch.num_rows)), batch.column("text")], names=["doc_id", "text"]
            )
            found = search_batch(rows, *search, least).column("doc_id").to_numpy()
            clean = np.ones(batch.num_rows, bool)
            clean[found] = False
            return batch.filter(pa.array(clean))

        kept = map_slices(kept, keep, documents.schema)
    return kept
