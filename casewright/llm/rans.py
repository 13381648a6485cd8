"""Static range asymmetric numeral system over token ids.

A shared table gives every symbol a share of ``2**SCALE`` slots.  A block is
encoded by itself: symbol ``i`` belongs to lane ``i % lanes``, each lane has
its own 64-bit state, and all lanes write to one stream of 32-bit words.
States and stream positions are kept at every ``CHECKPOINT`` steps, so a
decoder starts at all checkpoints at once; a checksum guards the block.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np

SCALE = 20
LOW = np.uint64(1 << 31)
LANES = 2048
CHECKPOINT = 128


class Table(NamedTuple):
    """Symbols that occur, their shares of the slots and where the shares begin."""

    symbols: np.ndarray
    shares: np.ndarray

    @property
    def begins(self) -> np.ndarray:
        return np.cumsum(self.shares) - self.shares


class Block(NamedTuple):
    count: int
    lanes: int
    crc: int
    words: np.ndarray
    states: np.ndarray  # one row per checkpoint
    offsets: np.ndarray  # stream position of every checkpoint


def table_of(ids: np.ndarray) -> Table:
    """Shares in proportion to the counts, one slot at least."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    if len(symbols) > 1 << SCALE:
        raise ValueError(f"more than {1 << SCALE} different ids")
    counts = counts[symbols]
    room = (1 << SCALE) - len(symbols)
    shares = 1 + counts * room // max(1, counts.sum())
    if len(shares):
        shares[np.argmax(shares)] += (1 << SCALE) - shares.sum()
    return Table(symbols, shares)


class Coder:
    """Encoder and decoder of blocks that share one table."""

    def __init__(self, table: Table):
        self.symbols = table.symbols.astype(np.uint32)
        self.share = table.shares.astype(np.uint64)
        self.begin = table.begins.astype(np.uint64)
        self.index = np.zeros(int(self.symbols.max(initial=0)) + 1, np.int32)
        self.index[self.symbols] = np.arange(len(self.symbols))

    def encode(self, ids: np.ndarray) -> Block:
        n = len(ids)
        lanes = int(min(LANES, max(1, n // 64)))
        steps = -(-n // lanes)
        index = self.index[ids]
        share, begin = self.share[index], self.begin[index]
        limit = share << np.uint64(63 - SCALE)
        shift, scale = np.uint64(32), np.uint64(SCALE)
        state = np.full(lanes, LOW, np.uint64)
        out, states, offsets, written = [], [], [], 0
        for t in range(steps - 1, -1, -1):
            here = slice(t * lanes, min(n, (t + 1) * lanes))
            f, x = share[here], state[: here.stop - here.start]
            full = x >= limit[here]
            words = x[full].astype(np.uint32)
            out.append(words)
            written += len(words)
            x = np.where(full, x >> shift, x)
            whole, rest = np.divmod(x, f)
            state[: len(f)] = (whole << scale) + rest + begin[here]
            if t % CHECKPOINT == 0:
                states.append(state.copy())
                offsets.append(written)
        stream = np.concatenate([np.empty(0, np.uint32), *out[::-1]])
        return Block(
            n,
            lanes,
            zlib.crc32(ids.astype("<u4").tobytes()),
            stream,
            np.array(states[::-1], np.uint64).reshape(-1, lanes),
            written - np.array(offsets[::-1], np.int64),
        )

    def slots(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.share), dtype=np.uint32), self.share.astype(np.int64))

    def decode(self, block: Block, slots: np.ndarray) -> np.ndarray:
        """Ids of a block, from all its checkpoints side by side."""
        n, lanes = block.count, block.lanes
        parts = len(block.states)
        out = np.zeros((parts, CHECKPOINT, lanes), np.uint32)
        state = block.states.copy()
        at = block.offsets.copy()
        words = np.append(block.words, np.uint32(0))
        begin = np.arange(parts)[:, None] * CHECKPOINT * lanes + np.arange(lanes)
        for t in range(min(CHECKPOINT, -(-n // lanes))):
            live = begin + t * lanes < n
            slot = state & np.uint64((1 << SCALE) - 1)
            index = slots[slot]
            x = self.share[index] * (state >> np.uint64(SCALE)) + slot - self.begin[index]
            need = (x < LOW) & live
            place = np.cumsum(need, axis=1)
            take = np.minimum(at[:, None] + place - 1, len(block.words))
            x = np.where(need, (x << np.uint64(32)) | words[take], x)
            state = np.where(live, x, state)
            at += place[:, -1]
            out[:, t] = self.symbols[index]
        ids = out.reshape(-1)[:n]
        if zlib.crc32(ids.astype("<u4").tobytes()) != block.crc:
            raise ValueError("checksum of a token block does not match")
        return ids
