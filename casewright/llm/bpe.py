"""Byte-pair encoding by an index of pair occurrences, and its inverse.

The pieces to encode are laid out as one array of symbols.  An index maps
every pair of neighbours that has a rank to all positions where it stands.
Ranks are taken in ascending order: all positions of the pair that still hold
it are merged at once, and the pairs that arise to their left and right are
entered into the lists of their ranks.  Lists are not searched for pairs that
disappear; a position is looked at again when its rank is taken.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.tokens import SLICE_BYTES, Encoder, tokenizer_path
from casewright.llm.words import raw, release_memory, slices

NONE = -1
# Slices of text that share an index.
GROUP = 8


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Visible Latin-1 characters stand for themselves, the other bytes for the
    code points from 256 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    letter = {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [letter[b] for b in range(256)]


class Merges:
    """Ranked pairs of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, split = content["model"], content.get("pre_tokenizer") or {}
        odd = [k for k in ("continuing_subword_prefix", "end_of_word_suffix", "dropout", "ignore_merges") if model.get(k)]
        if model.get("type") != "BPE" or split.get("type") != "ByteLevel" or content.get("normalizer") or odd:
            raise ValueError("only plain byte-level vocabularies are supported")
        vocab = model["vocab"]
        self.of_byte = np.array([vocab[c] for c in byte_letters()], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.size = 1 + max(vocab.values())
        self.left = np.array([vocab[a] for a, _ in pairs], np.int32)
        self.right = np.array([vocab[b] for _, b in pairs], np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = self.left.astype(np.int64) * self.size + self.right
        self.rank = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, or ``NONE``."""
        if not len(self.keys):
            return np.full(len(left), NONE)
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank[at], NONE)


class PairIndex:
    """Symbols of some pieces, linked to their neighbours, and the positions of each ranked pair."""

    def __init__(self, merges: Merges, data: np.ndarray, starts: np.ndarray):
        """``data`` holds the bytes of all pieces; a piece begins at each of ``starts``."""
        n = len(data)
        self.merges = merges
        self.symbol = merges.of_byte[data]
        self.next = np.arange(1, n + 1)
        self.before = np.arange(-1, n - 1)
        self.before[starts] = NONE
        self.next[np.append(starts[1:], n) - 1] = NONE
        self.live = np.ones(n, bool)
        self.taken = np.zeros(n, bool)
        self.places: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self.enter(np.flatnonzero(self.next != NONE))

    def enter(self, spots: np.ndarray) -> None:
        """Add the pairs that begin at ``spots`` to the lists of their ranks."""
        ranks = self.merges.ranks(self.symbol[spots], self.symbol[self.next[spots]])
        spots, ranks = spots[ranks != NONE], ranks[ranks != NONE]
        if not len(spots):
            return
        order = np.argsort(ranks, kind="stable")
        spots, ranks = spots[order], ranks[order]
        begins = np.flatnonzero(np.diff(ranks, prepend=NONE)).tolist()
        for a, b in zip(begins, [*begins[1:], len(ranks)]):
            rank = int(ranks[a])
            if rank not in self.places:
                self.places[rank] = []
                heapq.heappush(self.active, rank)
            self.places[rank].append(spots[a:b])

    def standing(self, rank: int, lists: list[np.ndarray]) -> np.ndarray:
        """The positions of the pair that still hold it, each symbol in one of them."""
        left, right = self.merges.left[rank], self.merges.right[rank]
        if len(lists) > 1 or left == right:
            spots = np.unique(np.concatenate(lists))
        else:
            spots = lists[0]
        after = self.next[spots]
        held = self.live[spots] & (after != NONE) & (self.symbol[spots] == left)
        held &= self.symbol[after] == right
        spots = spots[held]
        if left == right and len(spots) > 1:
            # In a row of equal symbols every second pair is taken, from the left.
            number = np.arange(len(spots))
            chained = np.append(False, self.next[spots[:-1]] == spots[1:])
            first = np.maximum.accumulate(np.where(chained, 0, number))
            spots = spots[(number - first) % 2 == 0]
        return spots

    def merge(self, rank: int, spots: np.ndarray) -> None:
        gone = self.next[spots]
        after = self.next[gone]
        self.symbol[spots] = self.merges.made[rank]
        self.live[gone] = False
        self.next[spots] = after
        linked = after != NONE
        self.before[after[linked]] = spots[linked]
        earlier = self.before[spots]
        earlier = earlier[earlier != NONE]
        # Of two merged neighbours the left one enters their pair.
        self.taken[spots] = True
        earlier = earlier[~self.taken[earlier]]
        self.taken[spots] = False
        self.enter(np.concatenate([earlier, spots[linked]]))

    def apply(self) -> None:
        """Merge until no pair has a rank."""
        while self.active:
            rank = heapq.heappop(self.active)
            spots = self.standing(rank, self.places.pop(rank))
            if len(spots):
                self.merge(rank, spots)


class PairEncoder(Encoder):
    """Ids of texts without an end id; merges are done by a pair index.

    The library only splits a chunk into pieces and names its special tokens.
    """

    def __init__(self, path: str):
        super().__init__(path, end=b"")
        self.merges = Merges(path)

    def encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        plain = [b"" if c in self.added else c for c in chunks]
        # A piece is written in one letter per byte, so its length counts bytes.
        sizes = [len(p) for c in plain if c for p, _ in split(c.decode())]
        data = np.frombuffer(b"".join(plain), np.uint8)
        ends = np.cumsum([len(c) for c in plain], dtype=np.int64)
        index = PairIndex(self.merges, data, np.cumsum(sizes, dtype=np.int64) - np.asarray(sizes, np.int64))
        index.apply()
        ids = index.symbol[index.live].astype("<u4").tobytes()
        stop = np.cumsum(index.live)[ends - 1] if len(data) else np.zeros(len(ends), np.int64)
        stop[ends == 0] = 0
        bounds = [0, *(4 * stop).tolist()]
        found = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
        return [
            self.added[c].to_bytes(4, "little") if c in self.added else x for c, x in zip(chunks, found)
        ]

    def encode_all(self, columns: list[pa.Array]) -> list[list[bytes]]:
        """Ids of the texts of some columns, with one index for the unknown chunks of all of them."""
        cut = [self.cut(c) for c in columns]
        kinds = list(dict.fromkeys(k for c in cut for k in c.kinds))
        ids = dict(zip(kinds, self._ids(kinds)))
        return [self.join(c, [ids[k] for k in c.kinds]) for c in cut]


class Decoder:
    """Texts of ids: the bytes of all tokens, joined; broken UTF-8 becomes U+FFFD, unknown ids nothing."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        of_letter = {c: b for b, c in enumerate(byte_letters())}
        tokens = dict(content["model"]["vocab"]) | {t["content"]: t["id"] for t in content["added_tokens"]}
        parts = [b""] * (1 + max(tokens.values(), default=-1))
        for token, i in tokens.items():
            known = all(c in of_letter for c in token)
            parts[i] = bytes(map(of_letter.get, token)) if known else token.encode()
        # One entry more, for ids beyond the vocabulary.
        self.size = np.array([*map(len, parts), 0], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)

    def decode(self, column: pa.Array) -> list[str]:
        """The text of each row of ``<u4`` ids; null is empty."""
        data, offsets = raw(column)
        ids = np.minimum(np.frombuffer(data.tobytes(), "<u4"), len(self.size) - 1)
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        text = self.bytes[np.repeat(self.begin[ids] - ends + size, size) + np.arange(total)].tobytes()
        bounds = np.append(0, ends)[offsets // 4].tolist()
        return [text[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]


@lru_cache(maxsize=1)
def pair_encoder(path: str) -> PairEncoder:
    return PairEncoder(path)


@lru_cache(maxsize=1)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def encode_texts(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of every whole text.

    A null or empty text has no ids; equal rows stay rows of their own; a null
    doc_id is kept; an empty table gives no rows; other columns are not looked
    at.  Nothing is shuffled.  A task holds the arrays over ``GROUP`` slices of
    text, or over one text if that is longer, and a bounded store of known chunks.
    """
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in batched(slices(batch, "text", SLICE_BYTES), GROUP):
                found = pair_encoder(path).encode_all([piece.column("text") for piece in some])
                for piece, ids in zip(some, found):
                    counts = pa.array([len(x) // 4 for x in ids], pa.int64())
                    yield pa.record_batch(
                        [piece.column("doc_id"), counts, pa.array(ids, pa.binary())],
                        names=["doc_id", "n_tokens", "ids"],
                    )
        release_memory()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode_ids(rows: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids and text of every row with ``ids``.

    Null ids give an empty text, ids outside the vocabulary nothing, and bytes
    that are no UTF-8 the replacement character.  Equal rows stay rows of their
    own, an empty table gives no rows, other columns are not looked at.
    """
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "ids", SLICE_BYTES):
                texts = pa.array(decoder(path).decode(piece.column("ids")), pa.string())
                yield pa.record_batch(
                    [*piece.select(["doc_id", "n_tokens", "ids"]).columns, texts],
                    names=["doc_id", "n_tokens", "ids", "text"],
                )
        release_memory()

    return rows.select("doc_id", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, text string"
    )
