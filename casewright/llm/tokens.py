"""Token ids of whole texts with a byte-level BPE file of the tokenizers library.

The library encodes a text piece by piece, and a piece never crosses a single
white-space byte between two visible ASCII neighbours, nor the border between
an ASCII letter or digit and a following sign.  Texts are cut there, every
different chunk is encoded once by the library, and its ids are kept in a
bounded store of the worker.  The ids are those of the uncut text, special
strings included: an added token's string stands for itself, as the library
does by default, so texts are cut at its borders and never inside it.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from casewright.llm.words import raw, span_hashes

END_ID = 0
# Chunks kept per generation; two generations live at a time.
KEPT_CHUNKS = 200_000
# Text tokenised at once; the arrays over its bytes take some fifty times as much.
SLICE_BYTES = 1 << 20
# Chunks that the library encodes in one call.
JOINED_CHUNKS = 2048
# Longer chunks are not kept, so that the store is bounded in bytes as well.
KEPT_BYTES = 64

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[list(b".,;:!?%$*#&|")] = True
_LOW = np.arange(256) <= 0x20  # every ASCII white space and control byte


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    return public_tokenizers.path(name)


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets at which the texts can be cut without changing their ids."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 4:
        at = data[3:-1]
        left, right = data[2:-2], data[4:]
        # No white space of Unicode starts with another byte than these or ends otherwise.
        wide = (left >= 0x80) & (
            (data[1:-3] == 0xC2) | ((data[:-4] >= 0xE1) & (data[:-4] <= 0xE3))
        )
        risky = (right == 0xC2) | ((right >= 0xE1) & (right <= 0xE3))
        space = ((at == 0x20) | (at == 0x0A)) & ~_LOW[left] & ~wide & ~_LOW[right] & ~risky
        cut[3 : n - 1] = space | (_SIGN[at] & _ALNUM[left])
    # Near the border of a text the neighbours belong to other texts: do not cut there.
    inner = offsets[(offsets >= 0) & (offsets <= n)]
    for shift in (-1, 0, 1, 2):
        near = inner + shift
        cut[near[(near >= 0) & (near <= n)]] = False
    cut[inner] = True
    return np.flatnonzero(cut)


def special_pattern(tokenizer: Tokenizer) -> re.Pattern[bytes] | None:
    """Matches the strings of added tokens, the longest first where several begin."""
    added = tokenizer.get_added_tokens_decoder().values()
    if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
        raise ValueError("added tokens that depend on their neighbours are not supported")
    strings = sorted({t.content.encode() for t in added}, key=len, reverse=True)
    return re.compile(b"|".join(map(re.escape, strings))) if strings else None


def special_spans(data: np.ndarray, offsets: np.ndarray, pattern: re.Pattern[bytes] | None) -> np.ndarray:
    """Begin and end of every special string inside one text, as rows."""
    text = data.tobytes()
    if pattern is None or not pattern.search(text):
        return np.empty((0, 2), np.int64)
    bounds = offsets.tolist()
    found = [m.span() for a, b in zip(bounds, bounds[1:]) for m in pattern.finditer(text, a, b)]
    return np.asarray(found, np.int64).reshape(-1, 2)


def chunk_borders(data: np.ndarray, offsets: np.ndarray, pattern: re.Pattern[bytes] | None) -> np.ndarray:
    """Borders of the chunks of all texts; a special string is a chunk of its own."""
    spans = special_spans(data, offsets, pattern)
    if not len(spans):
        return chunk_starts(data, offsets)
    starts = chunk_starts(data, np.union1d(offsets, spans))
    at = np.searchsorted(spans[:, 0], starts, side="left") - 1
    inside = (at >= 0) & (starts < spans[at, 1])
    return starts[~inside]


class Chunks(NamedTuple):
    """Different chunks, the kind of every chunk, and the first chunk of every text."""

    kinds: list[bytes]
    which: np.ndarray
    first: np.ndarray


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, with ``end`` appended."""

    def __init__(self, path: str, end: bytes = END_ID.to_bytes(4, "little")):
        # A task has one core; threads of the library would only take those of other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = special_pattern(self.tokenizer)
        self.added = {t.content.encode(): i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.end = end
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks that are not in the store.

        The library encodes what is between two special strings by itself, so
        many chunks go through one call, with special strings between them.
        """
        if not self.added:
            return [self._library(c.decode()).tobytes() for c in chunks]
        string, special = next(iter(self.added.items()))
        out: list[bytes] = []
        for at in range(0, len(chunks), JOINED_CHUNKS):
            some = chunks[at : at + JOINED_CHUNKS]
            # A chunk that is a special string is none here: it would look like a border.
            ids = self._library(string.join(b"" if c in self.added else c for c in some).decode())
            borders = np.flatnonzero(ids == special)
            begins, ends = np.append(0, borders + 1).tolist(), np.append(borders, len(ids)).tolist()
            packed = ids.tobytes()
            out.extend(
                self.added[c].to_bytes(4, "little") if c in self.added else packed[4 * a : 4 * b]
                for c, a, b in zip(some, begins, ends)
            )
        return out

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _ids(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of different chunks; unknown ones are encoded."""
        new, old = self.new, self.old
        out = list(map(new.get, chunks))
        other = [k for k, v in enumerate(out) if v is None]
        missing = []
        for k in other:
            if (v := old.get(chunks[k])) is None:
                missing.append(k)
            else:
                out[k] = v
        for k, ids in zip(missing, self.encode_chunks([chunks[k] for k in missing])):
            out[k] = ids
        new.update((c, out[k]) for k in other if len(c := chunks[k]) <= KEPT_BYTES)
        if len(new) > KEPT_CHUNKS:
            self.old, self.new = new, {}
        return out

    def cut(self, column: pa.Array) -> Chunks:
        """The different chunks of a column and where they stand; null is empty.

        Equal chunks are recognised by a 64-bit hash, so that the library and
        the store see each of them once.
        """
        data, offsets = raw(column)
        starts = chunk_borders(data, offsets, self.special)
        begin, stop = starts[:-1], starts[1:]
        _, some, which = np.unique(
            span_hashes(data, begin, stop), return_index=True, return_inverse=True
        )
        text = data.tobytes()
        kinds = [text[a:b] for a, b in zip(begin[some].tolist(), stop[some].tolist())]
        return Chunks(kinds, which, np.searchsorted(starts, offsets))

    def join(self, chunks: Chunks, ids: list[bytes]) -> list[bytes]:
        """Ids of every text, from the ids of its chunks."""
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        where = np.cumsum(size) - size
        sizes = size[chunks.which]
        ends = np.cumsum(sizes)
        places = np.repeat(where[chunks.which] - ends + sizes, sizes)
        packed = flat[places + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        bounds = np.concatenate([[0], ends])[chunks.first].tolist()
        return [packed[4 * a : 4 * b] + self.end for a, b in zip(bounds, bounds[1:])]

    def encode(self, column: pa.Array) -> list[bytes]:
        """Ids of every text of a column; null is empty."""
        chunks = self.cut(column)
        return self.join(chunks, self._ids(chunks.kinds))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids) & 0xFFFFFFFF
