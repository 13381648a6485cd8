"""A compressed FM-index over sequences of integer symbols, searched in batches.

The Burrows-Wheeler transform of the sequences is kept as a wavelet tree in
its pointerless form: one bit vector per level, packed into words with a count
per word.  Backward search extends a pattern to the left by one symbol; many
patterns are extended side by side with array operations.
"""

from __future__ import annotations

import numpy as np


class WaveletTree:
    """Bit vectors of a symbol sequence, most significant bit first."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels = levels
        self.words: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(levels - 1, -1, -1):
            bits = (symbols >> level & 1).astype(bool)
            packed = np.packbits(bits, bitorder="little")
            words = np.zeros(len(bits) // 64 + 1, "<u8")
            words.view(np.uint8)[: len(packed)] = packed
            ones = np.bitwise_count(words).astype(np.int32)
            self.words.append(words)
            self.counts.append(np.cumsum(ones, dtype=np.int32) - ones)
            self.zeros.append(int(len(bits) - ones.sum()))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def descend(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Follow each position to the bottom along the bits of its symbol."""
        for k in range(self.levels):
            word = position >> 6
            below = self.words[k][word] & ((np.uint64(1) << (position & 63).astype(np.uint64)) - np.uint64(1))
            ones = self.counts[k][word] + np.bitwise_count(below)
            bit = symbol >> (self.levels - 1 - k) & 1
            position = np.where(bit, self.zeros[k] + ones, position - ones)
        return position


class FMIndex:
    """Index of weighted sequences, for patterns of up to ``depth`` symbols.

    ``symbols`` holds codes from 1; 0 ends a sequence.  Suffixes are sorted by
    their first ``depth`` symbols, by prefix doubling, which is what searches
    of at most that length depend on.  ``weights`` gives every position the
    weight of its sequence; a pattern's count is the weight of its interval.
    """

    def __init__(self, symbols: np.ndarray, weights: np.ndarray, depth: int):
        n = len(symbols)
        rank, width = symbols.astype(np.int64), 1
        while width < depth:
            following = np.full(n, 0, np.int64)
            following[:-width] = rank[width:] + 1
            _, rank = np.unique(rank * (n + 2) + following, return_inverse=True)
            width *= 2
            if rank.max(initial=0) == n - 1:
                break
        order = np.argsort(rank, kind="stable")
        kinds = int(symbols.max(initial=0)) + 1
        self.size = n
        self.tree = WaveletTree(symbols[order - 1].astype(np.int64), max(1, (kinds - 1).bit_length()))
        # Where the block of a symbol begins, relative to its bottom position in the tree.
        code = np.arange(kinds)
        first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=kinds))])[:kinds]
        self.shift = first - self.tree.descend(code, np.zeros(kinds, np.int64))
        self.weight = np.concatenate([[0], np.cumsum(weights[order])])

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with ``symbol`` put before them."""
        both = np.concatenate([symbol, symbol])
        found = self.tree.descend(both, np.concatenate([low, high])) + self.shift[both]
        return found[: len(symbol)], found[len(symbol) :]

    def reach(self, text: np.ndarray, ends: np.ndarray, lefts: np.ndarray, least: int) -> np.ndarray:
        """Matching statistics by backward search.

        For every end the smallest start, down to ``left``, such that
        ``text[start:end]`` has a count of ``least`` or more.
        """
        at = ends.copy()
        active = np.flatnonzero(at > lefts)
        low = np.zeros(len(active), np.int64)
        high = np.full(len(active), self.size)
        while len(active):
            low, high = self.extend(text[at[active] - 1], low, high)
            found = self.weight[high] - self.weight[low] >= least
            active, low, high = active[found], low[found], high[found]
            at[active] -= 1
            more = at[active] > lefts[active]
            active, low, high = active[more], low[more], high[more]
        return at

    def repeated_windows(
        self, text: np.ndarray, starts: np.ndarray, counts: np.ndarray, window: int, least: int = 2
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of windows that occur ``least`` times or more.

        Document ``i`` streams the windows that start at ``starts[i]`` and the
        following ``counts[i] - 1`` positions of ``text``.  Returns document,
        first and last window (relative to its start) of every run.  Each
        search decides many windows: one from the end of the last open window
        confirms all windows it covers; one from the end of the first open
        window rules out all windows that hold what it could not extend.
        """
        document = np.arange(len(starts))
        first, last = starts.copy(), starts + counts - 1
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(document):
            reach = self.reach(text, last + window, first, least)
            hit = reach <= last
            found.append((document[hit], reach[hit], last[hit]))
            last = np.minimum(reach, last) - 1
            open_ = first <= last
            document, first, last = document[open_], first[open_], last[open_]
            if not len(document):
                break
            reach = self.reach(text, first + window, first, least)
            hit = reach == first
            found.append((document[hit], first[hit], first[hit]))
            first = np.where(hit, first + 1, reach)
            open_ = first <= last
            document, first, last = document[open_], first[open_], last[open_]
        if not found:
            return (np.empty(0, np.int64),) * 3
        document, first, last = (np.concatenate(x) for x in zip(*found))
        return document, first - starts[document], last - starts[document]
