"""Repetition inside a document by suffix array and longest common prefixes."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.llm.words import (
    Words,
    gram_hashes,
    map_slices,
    mixed,
    raw,
    span_hashes,
    text_of_words,
    word_hashes,
    words_of,
)

LEAST_REPEAT = 8
MAX_COVERED = 0.5
MAX_LONGEST = 100
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
REPEAT_WINDOW = 3
SYMBOLS = b"#*$%&|<>"

COLUMNS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, repeat_covered long, longest_repeat long"
)


class Repeats(NamedTuple):
    """Suffixes that share at least ``least`` words with a neighbour, and how many."""

    position: np.ndarray
    length: np.ndarray


def repeats(codes: np.ndarray, least: int) -> Repeats:
    """Longest repeat at every position of ``codes`` that has one of ``least`` or more.

    Prefix doubling orders the suffixes: the rank of a suffix is the place of
    its group in the suffix array, and a round sorts only those that still
    share their group.  Ranks of all rounds give the longest common prefix of
    neighbours in the array.  A maximal repeated substring is an interval of
    the array with one common prefix; the longest one that starts at a
    position has the larger common prefix with its two neighbours.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    levels, width = [rank.copy()], 1
    shared = order[_shared(new)]
    while len(shared):
        key_old = rank[shared]
        key_next = rank[np.minimum(shared + width, n)]
        order = np.lexsort((key_next, key_old))
        shared, old, following = shared[order], key_old[order], key_next[order]
        group = np.ones(len(shared), bool)
        group[1:] = old[1:] != old[:-1]
        new = group.copy()
        new[1:] |= following[1:] != following[:-1]
        index = np.arange(len(shared))
        rank[shared] = old + index[new][np.cumsum(new) - 1] - index[group][np.cumsum(group) - 1]
        levels.append(rank.copy())
        width *= 2
        shared = shared[_shared(new)]
    # Suffixes that share a prefix of the largest power of two up to ``least``.
    level = min(int(least).bit_length() - 1, len(levels) - 1)
    counts = np.bincount(levels[level][:n], minlength=n)
    found = np.flatnonzero(counts[levels[level][:n]] > 1) if 2**level <= least else np.empty(0, int)
    array = found[np.argsort(rank[found])]
    common = np.zeros(len(array) + 1, np.int64)
    if len(array) > 1:
        a, b = array[:-1], array[1:]
        length = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            at_a, at_b = np.minimum(a + length, n), np.minimum(b + length, n)
            length += (levels[k][at_a] == levels[k][at_b]) * np.int64(1 << k)
        common[1:-1] = length
    longest = np.maximum(common[:-1], common[1:])
    keep = longest >= least
    return Repeats(array[keep], longest[keep])


def _shared(new: np.ndarray) -> np.ndarray:
    """Members of groups of two or more, given where groups begin."""
    alone = new.copy()
    alone[:-1] &= new[1:]
    return ~alone


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Positions below ``n`` in the union of spans."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(change)[:n] > 0


def per_text(marks: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of a value per word for every text."""
    sums = np.concatenate([[0], np.cumsum(marks)])
    return sums[first[1:]] - sums[first[:-1]]


def own_codes(w: Words) -> np.ndarray:
    """A hash per word that differs between texts, so that nothing repeats across them."""
    return mixed(word_hashes(w) + mixed(text_of_words(w).astype(np.uint64) + np.uint64(1)))


def repeat_words(codes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Words per text in windows of ``size`` words found twice or more in it."""
    grams = gram_hashes(codes, size)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = np.flatnonzero(np.arange(len(grams)) + size <= first[1:][text[: len(grams)]])
    _, which, counts = np.unique(grams[inside], return_inverse=True, return_counts=True)
    hit = inside[counts[which] > 1]
    return per_text(covered(hit, hit + size, len(codes)), first)


def duplicate_lines(w: Words, offsets: np.ndarray) -> np.ndarray:
    """Lines per text that hold a word and equal an earlier line of the text."""
    newline = np.flatnonzero(w.data == 0x0A)
    starts = np.union1d(newline + 1, offsets[:-1])
    starts = starts[starts < len(w.data)]
    ends = np.searchsorted(newline, starts)
    ends = np.append(newline, len(w.data))[ends]
    text = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.minimum(ends, offsets[text + 1])
    begins = np.searchsorted(w.starts, starts)
    worded = np.searchsorted(w.starts, ends) > begins
    starts, ends, text = starts[worded], ends[worded], text[worded]
    key = mixed(span_hashes(w.data, starts, ends) + mixed(text.astype(np.uint64) + np.uint64(7)))
    _, some = np.unique(key, return_index=True)
    n = len(offsets) - 1
    return np.bincount(text, minlength=n) - np.bincount(text[some], minlength=n)


def measure(batch: pa.RecordBatch, least: int = LEAST_REPEAT) -> pa.RecordBatch:
    data, offsets = raw(batch.column("text"))
    w = words_of(data, offsets)
    codes = own_codes(w)
    visible = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    symbols = np.concatenate([[0], np.cumsum(symbol[data])])
    found = repeats(codes, least) if len(codes) else Repeats(*[np.empty(0, np.int64)] * 2)
    cover = covered(found.position, found.position + found.length, len(codes))
    longest = np.zeros(len(offsets) - 1, np.int64)
    np.maximum.at(longest, text_of_words(w)[found.position], found.length)
    values = [
        np.diff(w.first),
        per_text(visible[w.ends] - visible[w.starts], w.first),
        symbols[offsets[1:]] - symbols[offsets[:-1]],
        duplicate_lines(w, offsets),
        repeat_words(codes, w.first, REPEAT_WINDOW),
        per_text(cover, w.first),
        longest,
    ]
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    return pa.record_batch(
        [batch.column("doc_id"), *[pa.array(v.astype(np.int64)) for v in values]], names=names
    )


def repetition(documents: DataFrame, least: int = LEAST_REPEAT) -> DataFrame:
    """Word, symbol, line and repetition counts of every document.

    ``repeat_covered`` counts the words in the union of all maximal repeated
    substrings of at least ``least`` words, ``longest_repeat`` is the longest
    of them in words.  Each document is measured alone and in whole; nothing
    is shuffled.  A null text counts as empty (all zero), equal rows give
    equal rows, an empty table none, other columns are not looked at.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return map_slices(rows, lambda b: measure(b, least), COLUMNS)


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows of three."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def judged(documents: DataFrame, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """The counts of :func:`repetition` with ``base_failed`` and ``kept``."""
    repetitive = (F.col("repeat_covered") > max_covered * F.col("n_words")) | (
        F.col("longest_repeat") > max_longest
    )
    counted = repetition(documents)
    return counted.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & ~repetitive
    )


def keep_judged(
    documents: DataFrame, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST
) -> DataFrame:
    """The documents that :func:`judged` keeps, with all their columns."""

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = measure(batch)
        n, repeated, cover, longest = (
            found.column(c).to_numpy()
            for c in ("n_words", "n_repeat_words", "repeat_covered", "longest_repeat")
        )
        failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)
        failed |= (cover > max_covered * n) | (longest > max_longest)
        return batch.filter(pa.array(~failed))

    return map_slices(documents, keep, documents.schema)
