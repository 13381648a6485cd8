"""Hard negatives by the threshold algorithm.

Rows lie in blocks, and a block has one list per dimension, sorted by value.
An anchor walks every list from the end its own sign asks for: the highest
values first where the anchor's component is positive, the lowest where it is
negative.  Rows met on the way are scored at once by random access.  The
products at the depth reached add up to a threshold that no row unseen so far
can pass; once it falls strictly below the k-th score of every window of the
anchor, the rest of the block is left unread.  The lists of several anchors
are walked together, so that scores are matrix products.

All arithmetic is exact: components are whole numbers, and products are taken
in double precision where every sum stays below 2**53, in 64-bit integers
where it stays below 2**62, and refused beyond that.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import batched
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casewright.llm.words import rows_per_batch
from casewright.session import shared_folder

# Anchors that one pass over all rows serves; their components travel with the tasks.
PASS_ANCHORS = 16_384
# Anchors whose lists are walked together.
TOGETHER = 32
BLOCK_ROWS = 4096
# Rows read from every list before the threshold is looked at, and how that depth grows.
FIRST_DEPTH = 16
DEEPER = 4
# The score of places not yet filled.
EMPTY = -(2**63)

ROWS = "uid long, vec_id long, label long, vector array<double>"
FOUND = "anchor long, window int, vec_id long, uid long, score long"


class Anchors(NamedTuple):
    """Anchors of a pass, and the windows each of them has to fill."""

    uid: np.ndarray
    label: np.ndarray
    vector: np.ndarray
    owner: np.ndarray  # the anchor of every window, ascending
    number: np.ndarray  # the window's number within its anchor
    low: np.ndarray  # least and largest score of the window
    high: np.ndarray


def scaled_rows(rows: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """uid, vec_id, label and the components floor(scale * x) of the rows that take part.

    Rows without an id, a label or a vector, and rows with a null or
    non-finite component (before or after scaling) take no part.
    """
    exact = F.transform(vector, lambda x: x.cast("double") * scale)
    good = F.forall(exact, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # floor() gives a long; larger components are whole numbers already.
    whole = F.transform(
        exact, lambda x: F.when(F.abs(x) < 2.0**62, F.floor(x).cast("double")).otherwise(x)
    )
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & good).select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        whole.alias("vector"),
    )


def matrix_of(vectors: list | pa.Array, width: int = 1) -> np.ndarray:
    """One row per vector; shorter ones end in zeros."""
    if isinstance(vectors, list):
        vectors = pa.array(vectors, pa.list_(pa.float64()))
    sizes = np.asarray(vectors.value_lengths(), np.int64)
    flat = np.asarray(vectors.flatten(), float)
    out = np.zeros((len(sizes), max(int(sizes.max(initial=0)), width)))
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), place] = flat
    return out


def exact_type(left: np.ndarray, right: np.ndarray) -> type:
    """A type in which products of rows of the two matrices are exact."""
    bound = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * left.shape[1]
    if bound >= 2**62:
        raise ValueError("scores do not fit into a long")
    return np.float64 if bound < 2**53 else np.int64


class Best:
    """The k best rows of every window so far: score down, then vec_id, then uid."""

    def __init__(self, windows: int, k: int):
        self.k = k
        self.score = np.full((windows, k), EMPTY)
        self.vec_id = np.zeros((windows, k), np.int64)
        self.uid = np.zeros((windows, k), np.int64)

    @property
    def last(self) -> np.ndarray:
        """The k-th score, ``EMPTY`` where there are fewer."""
        return self.score[:, -1]

    def offer(self, w: int, score: np.ndarray, vec_id: np.ndarray, uid: np.ndarray) -> None:
        score = np.concatenate([self.score[w], score.astype(np.int64)])
        vec_id = np.concatenate([self.vec_id[w], vec_id])
        uid = np.concatenate([self.uid[w], uid])
        best = np.lexsort((uid, vec_id, ~score))[: self.k]
        self.score[w], self.vec_id[w], self.uid[w] = score[best], vec_id[best], uid[best]


class Block:
    """Some rows and their sorted lists, one per dimension."""

    def __init__(self, uid: np.ndarray, vec_id: np.ndarray, label: np.ndarray, vector: np.ndarray):
        self.uid, self.vec_id, self.label, self.vector = uid, vec_id, label, vector
        self.down = np.argsort(-vector, axis=0, kind="stable").T
        self.values = np.take_along_axis(vector.T, self.down, axis=1)

    def threshold(self, anchors: np.ndarray, depth: int) -> np.ndarray:
        """What no row behind the first ``depth`` of every list can pass, for each anchor."""
        high, low = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return high @ self.values[:, depth - 1] + low @ self.values[:, len(self.uid) - depth]

    def search(self, anchors: Anchors, group: np.ndarray, best: Best, same: bool) -> int:
        """Fill the windows of a group of anchors of one label; returns the rows scored."""
        label = anchors.label[group[0]]
        fitting = (self.label == label) == same
        windows = np.arange(*np.searchsorted(anchors.owner, [group[0], group[-1] + 1]))
        rows, seen, depth, before = len(self.uid), np.zeros(len(self.uid), bool), 1, 0
        if not fitting.any():
            return 0
        while len(windows):
            # Windows whose k-th score, or least score, is above the threshold need nothing more.
            walkers, place = np.unique(anchors.owner[windows], return_inverse=True)
            bound = self.threshold(anchors.vector[walkers], max(1, before))[place]
            windows = windows[(bound >= best.last[windows]) & (bound >= anchors.low[windows])]
            if not len(windows) or before >= rows:
                break
            depth = min(rows, before * DEEPER or FIRST_DEPTH)
            walkers = np.unique(anchors.owner[windows])
            signs = anchors.vector[walkers]
            met = np.zeros(rows, bool)
            met[self.down[(signs > 0).any(axis=0), before:depth].ravel()] = True
            met[self.down[(signs < 0).any(axis=0), rows - depth : rows - before].ravel()] = True
            if not signs.any(axis=1).all():
                # An anchor of zeros has no end to begin at and takes the first list as it is.
                met[self.down[:1, before:depth].ravel()] = True
            new = np.flatnonzero(met & ~seen)
            seen |= met
            new = new[fitting[new]]
            scores = self.vector[new] @ signs.T
            for w in windows.tolist():
                column = scores[:, np.searchsorted(walkers, anchors.owner[w])]
                take = column >= max(anchors.low[w], best.last[w])
                take &= column <= anchors.high[w]
                if same:
                    take &= self.uid[new] != anchors.uid[anchors.owner[w]]
                if take.any():
                    some = new[take]
                    best.offer(w, column[take], self.vec_id[some], self.uid[some])
            before = depth
        return int(seen.sum())


def groups_of(anchors: Anchors) -> list[np.ndarray]:
    """Runs of at most ``TOGETHER`` anchors of one label; anchors come ordered by label."""
    borders = np.flatnonzero(np.diff(anchors.label)) + 1
    return [
        np.asarray(some)
        for run in np.split(np.arange(len(anchors.uid)), borders)
        for some in batched(run.tolist(), TOGETHER)
    ]


def best_of_windows(rows: DataFrame, anchors: Anchors, k: int, same: bool, folder: str) -> None:
    """Write the k best rows of every window: of the anchor's label (``same``) or of the others.

    Every task fills the windows from its own rows, block by block, and sends
    at most k rows per window; a window of the shuffled rows picks k of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(anchors.owner), k)
        groups = groups_of(anchors)
        for batch in batches:
            vector = matrix_of(batch.column("vector"), anchors.vector.shape[1])
            wider = np.pad(anchors.vector, ((0, 0), (0, vector.shape[1] - anchors.vector.shape[1])))
            kind = exact_type(vector, wider)
            ids = [np.asarray(batch.column(c)) for c in ("uid", "vec_id", "label")]
            block, here = Block(*ids, vector.astype(kind)), anchors._replace(vector=wider.astype(kind))
            for group in groups:
                block.search(here, group, best, same)
        w, at = np.nonzero(best.score > EMPTY)
        owner = anchors.owner[w]
        out = [anchors.uid[owner], anchors.number[w].astype(np.int32), best.vec_id[w, at], best.uid[w, at]]
        yield pa.record_batch(
            [*map(pa.array, out), pa.array(best.score[w, at])],
            names=["anchor", "window", "vec_id", "uid", "score"],
        )

    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id", "uid")
    with rows_per_batch(rows.sparkSession, BLOCK_ROWS):
        rows.mapInArrow(run, FOUND).select("*", F.row_number().over(order).alias("rank")).where(
            F.col("rank") <= k
        ).write.parquet(folder)


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """Negatives of every anchor and positive, with scores between shares of the positive's score.

    ``rows`` has uid, vec_id, label and vector as :func:`scaled_rows` gives
    them, stored, and ``anchors`` are some of these rows.  An anchor's
    positives are its first ``positives`` other rows of the same label by
    score, then vec_id, then uid.  For each, the first ``negatives`` rows of
    other labels with low * positive <= 100 * score <= high * positive are
    returned: anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score, with the uids of all three.

    Repeated rows are rows of their own: only the anchor's own row (its uid)
    is no positive of it.  Shorter vectors end in zeros.  Anchors without
    positives, windows without rows and empty tables give no rows.  Rows are
    never moved: anchors come in passes of ``PASS_ANCHORS``, each one pass over
    the rows for the positives and one for the negatives.
    """
    spark = rows.sparkSession
    folder = shared_folder(spark, "negatives")
    ordered = anchors.select("uid", "vec_id", "label", "vector").orderBy("label", "uid")
    passes = 0
    for some in batched(ordered.toLocalIterator(), PASS_ANCHORS):
        uid, vec_id, label, vector = (list(x) for x in zip(*some))
        count = np.arange(len(uid))
        block = Anchors(
            np.array(uid, np.int64), np.array(label, np.int64), matrix_of(vector), count, 0 * count,
            np.full(len(uid), EMPTY), np.full(len(uid), 2**63 - 1),
        )
        near = f"{folder}/positives-{passes}"
        best_of_windows(rows, block, positives, True, near)
        # At most `positives` rows for each anchor of the pass.
        found = spark.read.parquet(near).select("anchor", "rank", "score").collect()
        at = {u: i for i, u in enumerate(uid)}
        found.sort(key=lambda r: (at[r.anchor], r.rank))
        windows = block._replace(
            owner=np.array([at[r.anchor] for r in found], np.int64),
            number=np.array([r.rank for r in found], np.int64),
            low=np.array([-(-low * r.score // 100) for r in found], np.int64),
            high=np.array([high * r.score // 100 for r in found], np.int64),
        )
        best_of_windows(rows, windows, negatives, False, f"{folder}/negatives-{passes}")
        passes += 1
    if not passes:
        near, far = (spark.createDataFrame([], f"{FOUND}, rank int") for _ in range(2))
    else:
        near, far = (
            spark.read.parquet(*[f"{folder}/{kind}-{i}" for i in range(passes)])
            for kind in ("positives", "negatives")
        )
    named = anchors.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    positive = near.select(
        "anchor",
        F.col("rank").alias("window"),
        F.col("vec_id").alias("positive_id"),
        F.col("uid").alias("positive_uid"),
        F.col("score").alias("positive_score"),
    )
    return (
        far.select(
            "anchor",
            "window",
            "rank",
            F.col("vec_id").alias("negative_id"),
            F.col("uid").alias("negative_uid"),
            F.col("score").alias("negative_score"),
        )
        .join(positive, ["anchor", "window"])
        .join(named, "anchor")
        .withColumnRenamed("anchor", "anchor_uid")
        .drop("window")
    )


def stored_rows(rows: DataFrame) -> DataFrame:
    """Write scaled rows to the shared folder, so that their uids stay what they are."""
    folder = shared_folder(rows.sparkSession, "scaled")
    rows.write.parquet(folder)
    return rows.sparkSession.read.parquet(folder)
