"""SimHash near-duplicates by fuzzy hashing with the binary Golay code.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits (the last one
filled up with zeros).  The perfect (23, 12) Golay code has one codeword within
distance 3 of any word, and words at distance 3 have five more at distance 4.
Listing all codewords within distance 4 gives a word one or six keys of 12
bits, and two words that differ in at most two bits share a key.  If two
fingerprints differ in at most four bits, the two best of the three segments
differ in at most two bits together, so the fingerprints share a composite key
of some pair of segments.  Candidates with a common key are verified on all 64
bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.components import components
from casewright.llm.words import map_slices
from casewright.session import shared_folder

SHINGLE = 4
DISTANCE = 4
SEED = 42
SEGMENTS = ((0, 23), (23, 23), (46, 18))
PAIRS = tuple(combinations(range(len(SEGMENTS)), 2))
# Fixed value: generator polynomial of the (23, 12) Golay code.
GENERATOR = 0b101011100011
# Entries one verification task should hold.
TASK_ENTRIES = 1 << 20
# Buckets up to this size are compared by shifts, larger ones one by one.
SMALL_BUCKET = 32


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Check bits of the messages; message parts and counts of near error patterns by syndrome."""
    checks = np.arange(4096) << 11
    for bit in range(22, 10, -1):
        checks ^= np.where(checks >> bit & 1, GENERATOR << (bit - 11), 0)
    near = np.zeros((2048, 6), np.int64)
    count = np.zeros(2048, np.int64)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            error = sum(1 << b for b in bits)
            syndrome = int(checks[error >> 11]) ^ (error & 2047)
            near[syndrome, count[syndrome]] = error >> 11
            count[syndrome] += 1
    return checks, near, count


def segment_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Messages of all codewords within distance 4 of 23-bit words, and how many there are."""
    checks, near, count = golay()
    message = words >> 11
    syndrome = checks[message] ^ (words & 2047)
    return message[:, None] ^ near[syndrome], count[syndrome]


def composite_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every composite key of the fingerprints (unsigned 64-bit)."""
    parts = [
        segment_keys(((prints >> np.uint64(at)) & np.uint64((1 << size) - 1)).astype(np.int64))
        for at, size in SEGMENTS
    ]
    rows, keys = [], []
    for pair, (i, j) in enumerate(PAIRS):
        (a, na), (b, nb) = parts[i], parts[j]
        for x in range(6):
            for y in range(6):
                row = np.flatnonzero((na > x) & (nb > y))
                rows.append(row)
                keys.append((pair << 24) | (a[row, x] << 12) | b[row, y])
    return np.concatenate(rows), np.concatenate(keys)


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the 64-bit fingerprint (as a signed long) of every whole text.

    Bit k is set if it is set in over half of the hashes of the shingles,
    repeats included.  A text shorter than a shingle is hashed in whole; one
    without words, empty or null, has fingerprint zero.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return map_slices(rows, lambda b: fingerprint_batch(b, shingle), "doc_id long, fingerprint long")


def fingerprint_batch(batch: pa.RecordBatch, shingle: int = SHINGLE) -> pa.RecordBatch:
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = []
    for text in batch.column("text").cast(pa.binary()).to_pylist():
        words = text.lower().split() if text else []
        n = len(words)
        if n:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
            starts = [0, *ends[:-1].tolist()]
            stops = (ends - 1)[min(shingle, n) - 1 :].tolist()
            hashes += [digest(joined[a:b], SEED) for a, b in zip(starts, stops)]
        counts.append(max(1, n - shingle + 1) if n else 0)
    count = np.asarray(counts, np.int64)
    prints = np.zeros(len(count), np.uint64)
    if hashes:
        bits = np.unpackbits(
            np.asarray(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        full = count > 0
        starts = (np.cumsum(count) - count)[full]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        major = 2 * ones > count[full][:, None]
        prints[full] = np.packbits(major, axis=1, bitorder="little").view("<u8")[:, 0]
    return pa.record_batch(
        [batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "fingerprint"]
    )


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Reduce links to (value, least value of its component), the least ones left out."""
    values, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = index[: len(a)], index[len(a) :]
    root = np.arange(len(values))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while (root[root] != root).any():
            root = root[root]
        if (before == root).all():
            break
    moved = root != np.arange(len(values))
    return values[moved], values[root[moved]]


def bucket_links(keys: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect, inside each key, all fingerprints within ``distance`` of each other.

    Small buckets are compared pair by pair.  In a large one each fingerprint
    in turn takes in what is near it and has not been reached yet, so a dense
    bucket is used up in few steps and gives one link per fingerprint.
    """
    order = np.lexsort((prints, keys))
    keys, prints = keys[order], prints[order]
    single = np.ones(len(keys), bool)
    single[1:] = (keys[1:] != keys[:-1]) | (prints[1:] != prints[:-1])
    keys, prints = keys[single], prints[single]
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(begins, len(keys)))
    large = sizes > SMALL_BUCKET
    left, right = [], []
    small = np.repeat(~large, sizes)
    k, p = keys[small], prints[small]
    for shift in range(1, min(SMALL_BUCKET, len(k))):
        at = np.flatnonzero(k[shift:] == k[:-shift])
        if not len(at):
            break
        near = np.bitwise_count(p[at] ^ p[at + shift]) <= distance
        left.append(p[at[near]])
        right.append(p[at[near] + shift])
    for begin, size in zip(begins[large].tolist(), sizes[large].tolist()):
        rest = prints[begin : begin + size]
        while len(rest):
            todo, rest = [rest[:1]], rest[1:]
            while todo and len(rest):
                for pivot in todo.pop():
                    near = np.bitwise_count(rest ^ pivot) <= distance
                    if near.any():
                        found = rest[near]
                        left.append(np.full(len(found), pivot))
                        right.append(found)
                        todo.append(found)
                        rest = rest[~near]
    none = np.empty(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links a, b that connect all fingerprints within ``distance`` bits.

    ``prints`` has one row per different fingerprint.  Keys travel packed by
    key range; the number of ranges follows the number of fingerprints, so a
    task's share does not.  Only a spanning forest of the verified links of a
    range is returned, never all pairs of a bucket.
    """
    if not 0 <= distance <= 4:
        raise ValueError("three Golay segments guarantee up to four differing bits")
    count = prints.count()
    ranges = max(1, -(-count * 85 // TASK_ENTRIES))
    packed = "range int, keys binary, prints binary"

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fingerprint").to_numpy().view(np.uint64)
            for at in range(0, len(values), 1 << 15):
                part = values[at : at + (1 << 15)]
                row, key = composite_keys(part)
                where = (key * 2654435761 & 0xFFFFFFFF) * ranges >> 32
                order = np.argsort(where, kind="stable")
                row, key, where = row[order], key[order].astype(np.int32), where[order]
                kinds, begins = np.unique(where, return_index=True)
                ends = np.append(begins[1:], len(where))
                yield pa.record_batch(
                    [
                        pa.array(kinds.astype(np.int32)),
                        pa.array([key[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
                        pa.array([part[row[a:b]].tobytes() for a, b in zip(begins, ends)], pa.binary()),
                    ],
                    names=["range", "keys", "prints"],
                )

    def verify(table: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(table["keys"].to_pylist()), np.int32)
        values = np.frombuffer(b"".join(table["prints"].to_pylist()), np.uint64)
        a, b = forest(*bucket_links(keys, values, distance))
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return (
        prints.select("fingerprint")
        .mapInArrow(spread, packed)
        .groupBy("range")
        .applyInArrow(verify, "a long, b long")
    )


def near_duplicates(
    documents: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """doc_id, fingerprint and component_id of every document.

    Documents with equal fingerprints are one node, however many they are.
    Components of the links are found in the shared folder; ``component_id``
    is the least doc_id of the component.  Documents without words share
    fingerprint zero.  Equal rows give equal rows; a null doc_id takes part
    but is never the least; an empty table gives no rows; other columns are
    not looked at.
    """
    spark = documents.sparkSession
    folder = shared_folder(spark, "fingerprints")
    fingerprints(documents, shingle).write.parquet(folder)
    stored = spark.read.parquet(folder)
    nodes = stored.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes, distance)).withColumnsRenamed({"node": "fingerprint"})
    rooted = nodes.join(roots, "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fingerprint", "component_id")
    return stored.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(documents: DataFrame) -> DataFrame:
    """The document with the least id of every component, with all its columns.

    Rows that repeat a kept doc_id are dropped as well; rows without an id
    cannot stand for a component and stay.
    """
    known = documents.where(F.col("doc_id").isNotNull())
    found = near_duplicates(known)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    one = known.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return one.select(*documents.columns).unionByName(documents.where(F.col("doc_id").isNull()))
