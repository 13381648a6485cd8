"""Scores of answers, retrieval results and text pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.functions.scoring import answer_scores
from casewright.functions.text import tokens


def score_answers(answers: DataFrame, answer: str = "answer") -> DataFrame:
    """The input with one column per scorer."""
    return answers.withColumns(answer_scores(F.col(answer)))


def summarise_scores(scored: DataFrame, scorers: list[str]) -> DataFrame:
    """(metric, value): the mean of each scorer; booleans count as 0 and 1."""
    kinds = dict(scored.dtypes)

    def number(name: str) -> Column:
        c = F.col(name)
        return (c.cast("int") if kinds[name] == "boolean" else c).cast("double")

    means = scored.agg(*[F.avg(number(s)).alias(s) for s in scorers])
    return means.unpivot([], scorers, "metric", "value")


def retrieval_metrics(hits: DataFrame, relevant_totals: DataFrame, k: int) -> DataFrame:
    """precision@k, recall@k, reciprocal rank and NDCG@k per query.

    ``hits`` has query_id, rank (from 1) and relevant (boolean); it holds at
    most ``k`` rows per query.  ``relevant_totals`` has query_id and
    total_relevant.  Queries without hits score 0.
    """
    rel = F.col("relevant").cast("int")
    per_query = hits.where(F.col("rank") <= k).groupBy("query_id").agg(
        F.sum(rel).alias("found"),
        F.min(F.when(F.col("relevant"), F.col("rank"))).alias("first_hit"),
        F.sum(rel / F.log2(F.col("rank") + 1)).alias("dcg"),
    )
    ideal_hits = F.least(F.col("total_relevant"), F.lit(k)).cast("int")
    ideal = F.when(
        ideal_hits > 0,
        F.aggregate(
            F.sequence(F.lit(1), F.greatest(ideal_hits, F.lit(1))),
            F.lit(0.0),
            lambda acc, i: acc + F.lit(1.0) / F.log2(i + 1),
        ),
    )
    zero = F.lit(0.0)
    return relevant_totals.join(per_query, "query_id", "left").select(
        "query_id",
        F.coalesce(F.col("found") / F.lit(k), zero).alias("precision"),
        F.coalesce(F.try_divide("found", "total_relevant"), zero).alias("recall"),
        F.coalesce(F.lit(1.0) / F.col("first_hit"), zero).alias("mrr"),
        F.coalesce(F.try_divide(F.col("dcg"), ideal), zero).alias("ndcg"),
    )


# Pairs whose n-grams are counted at a time.
_COUNTED_ROWS = 1_000
_OVERLAP = "array<struct<n:int,matches:long,candidate_total:long,reference_total:long>>"


def _overlap(candidates: Column, references: Column, max_n: int) -> Column:
    """Matches and totals per n of each row; both sides are array<array<string>>, the tokens of its texts.

    Grams are numbered many rows at a time, those of n from those of n - 1 and the next token.
    """

    def some(mine: pa.Array, other: pa.Array) -> pa.Array:
        rows, texts, words = [], [], []
        for side in (mine, other):
            inner = side.flatten()
            rows.append(np.repeat(np.arange(len(side)), side.value_lengths().to_numpy()))
            texts.append(inner.value_lengths().to_numpy().astype(np.int64))
            words.append(inner.flatten())
        lengths = np.concatenate(texts)
        text = np.repeat(np.arange(len(lengths)), lengths)
        row = np.concatenate(rows)[text].astype(np.int64)
        is_mine = text < len(texts[0])
        left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(text))
        coded = pa.chunked_array(words, pa.string()).combine_chunks().dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        kinds = max(1, len(coded.dictionary))
        found = []
        at, gram = np.arange(len(code)), code
        for n in range(1, max_n + 1):
            if n > 1:
                fits = left[at] >= n
                at = at[fits]
                gram = np.unique(gram[fits] * kinds + code[at + n - 1], return_inverse=True)[1]
            if not len(at):
                break
            keys, inverse = np.unique(row[at] * (gram.max() + 1) + gram, return_inverse=True)
            c = np.bincount(inverse, is_mine[at], len(keys)).astype(np.int64)
            r = np.bincount(inverse, ~is_mine[at], len(keys)).astype(np.int64)
            owner = keys // (gram.max() + 1)
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            sums = [np.add.reduceat(x, starts) for x in (np.minimum(c, r), c, r)]
            found.append(np.stack([owner[starts], np.full(len(starts), n), *sums]))
        table = np.concatenate(found, axis=1) if found else np.zeros((5, 0), np.int64)
        table = table[:, np.argsort(table[0], kind="stable")]
        offsets = np.searchsorted(table[0], np.arange(len(mine) + 1)).astype(np.int32)
        names = ["n", "matches", "candidate_total", "reference_total"]
        arrays = [pa.array(table[1].astype(np.int32)), *[pa.array(x) for x in table[2:]]]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(arrays, names))

    @F.arrow_udf(_OVERLAP)
    def counted(mine: pa.Array, other: pa.Array) -> pa.Array:
        starts = range(0, max(1, len(mine)), _COUNTED_ROWS)
        return pa.concat_arrays([some(*(x.slice(a, _COUNTED_ROWS) for x in (mine, other))) for a in starts])

    return counted(candidates, references)


def ngram_overlap(pairs: DataFrame, max_n: int = 1) -> DataFrame:
    """Clipped n-gram matches per pair and n.

    ``pairs`` has pair_id, candidate and reference.  The texts of a pair meet
    in one row and its n-grams are counted there, in time linear in the text:
    what is shuffled are the texts, not their n-grams.
    Returns pair_id, n, matches, candidate_total, reference_total.
    """
    texts = pairs.groupBy("pair_id").agg(
        F.collect_list("candidate").alias("c"), F.collect_list("reference").alias("r")
    )
    counts = _overlap(F.transform("c", tokens), F.transform("r", tokens), max_n)
    return texts.select("pair_id", F.inline(counts))


def text_overlap_metrics(pairs: DataFrame) -> DataFrame:
    """exact_match, token_f1 and rouge1 (recall) per pair.

    Exact match compares the token sequences, so case and punctuation do not
    count.
    """
    exact = pairs.select(
        "pair_id",
        (tokens(F.col("candidate")) == tokens(F.col("reference"))).alias("exact_match"),
    )
    overlap = ngram_overlap(pairs).where(F.col("n") == 1)
    zero = F.lit(0.0)
    return exact.join(overlap, "pair_id", "left").select(
        "pair_id",
        "exact_match",
        F.coalesce(
            F.try_divide(
                2 * F.col("matches"), F.col("candidate_total") + F.col("reference_total")
            ),
            zero,
        ).alias("token_f1"),
        F.coalesce(F.try_divide("matches", "reference_total"), zero).alias("rouge1"),
    )


def bleu(pairs: DataFrame, max_n: int = 4) -> DataFrame:
    """BLEU per pair: geometric mean of clipped precisions, brevity penalty.

    No smoothing (Papineni et al. 2002): a missing order gives 0.
    """
    overlap = ngram_overlap(pairs, max_n)
    per_pair = overlap.groupBy("pair_id").agg(
        F.sum(F.when(F.col("matches") > 0, F.log(F.col("matches") / F.col("candidate_total")))).alias("logs"),
        F.count_if(F.col("matches") > 0).alias("orders"),
        F.max(F.when(F.col("n") == 1, F.col("candidate_total"))).alias("c"),
        F.max(F.when(F.col("n") == 1, F.col("reference_total"))).alias("r"),
    )
    penalty = F.when(F.col("c") > F.col("r"), F.lit(1.0)).otherwise(
        F.exp(F.lit(1.0) - F.col("r") / F.col("c"))
    )
    score = F.when(F.col("orders") == max_n, penalty * F.exp(F.col("logs") / max_n))
    return pairs.select("pair_id").join(
        per_pair.select("pair_id", score.alias("bleu")), "pair_id", "left"
    ).select("pair_id", F.coalesce("bleu", F.lit(0.0)).alias("bleu"))
