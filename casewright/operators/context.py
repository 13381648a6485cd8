"""Context assembly for retrieved passages.

Everything here works on ranked hits, which hold at most ``k`` rows per query,
so gathering the rows of a query gathers ``k`` rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.functions.text import excerpt, sentences, strip, token_estimate, tokens
from casewright.operators.ranking import top_k
from casewright.operators.search import HIT_BYTES, token_jaccard
from casewright.session import shared_folder


def order_for_attention(hits: DataFrame, keep_all: bool = False) -> DataFrame:
    """Best passage first, second best last, the others between; ``position``.

    With three passages or more the least relevant one is left out unless
    ``keep_all`` is set.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy("query_id"))
    rank, total = F.col("rank"), F.col("_n")
    kept = total if keep_all else total - 1
    position = (
        F.when(total <= 2, rank)
        .when(rank == 1, rank)
        .when(rank == 2, kept)
        .otherwise(rank - 1)
    )
    out = hits.withColumn("_n", n)
    if not keep_all:
        out = out.where((F.col("_n") <= 2) | (rank < F.col("_n")) | (rank == 2))
    return out.withColumn("position", position.cast("long")).drop("_n")


def order_by_role(hits: DataFrame, role: str = "role") -> DataFrame:
    """Declarations first, then invoices, then royalty agreements; ``position``."""
    preference = (
        F.when(F.col(role) == "declaration", 0)
        .when(F.col(role) == "invoice", 1)
        .when(F.col(role) == "royalty", 2)
        .otherwise(3)
    )
    w = Window.partitionBy("query_id").orderBy(preference, "rank")
    return hits.withColumn("position", F.row_number().over(w))


def order_by_source(hits: DataFrame, source: str = "document_id") -> DataFrame:
    """Passages of one document together, documents by their best rank; ``position``."""
    lead = F.min("rank").over(Window.partitionBy("query_id", source))
    w = Window.partitionBy("query_id").orderBy("_lead", "rank")
    return (
        hits.withColumn("_lead", lead)
        .withColumn("position", F.row_number().over(w))
        .drop("_lead")
    )


def available_tokens(window: int, system: int, query: int, output: int) -> int:
    """Tokens left for context."""
    return window - system - query - output


def within_budget(hits: DataFrame, budget: int, text: str = "text") -> DataFrame:
    """The best-ranked hits whose token estimates add up to at most ``budget``."""
    running = (
        Window.partitionBy("query_id")
        .orderBy("rank")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return hits.withColumn(
        "used_tokens", F.sum(token_estimate(F.col(text))).over(running)
    ).where(F.col("used_tokens") <= budget)


def without_near_duplicates(
    hits: DataFrame, threshold: float = 0.8, text: str = "text"
) -> DataFrame:
    """Drop a hit when a better-ranked hit of its query has nearly the same tokens.

    The pool of a query is compared inside one row; no pairs are emitted.
    """
    others = [c for c in hits.columns if c != "query_id"]
    pool = (
        hits.withColumn("_t", F.array_distinct(tokens(F.col(text))))
        .groupBy("query_id")
        .agg(F.collect_list(F.struct("rank", "_t", F.struct(*others).alias("_row"))).alias("_p"))
    )
    kept = F.filter(
        "_p",
        lambda h: ~F.exists(
            "_p",
            lambda o: (o["rank"] < h["rank"]) & (token_jaccard(o["_t"], h["_t"]) >= threshold),
        ),
    )
    return pool.select("query_id", F.explode(kept).alias("_h")).select(
        "query_id", *[F.col("_h")["_row"][c].alias(c) for c in others]
    )


BLOCK_SEPARATOR = "\n---\n"


def passage_block(rank: Column, id_: Column, case_id: Column, text: Column) -> Column:
    """One numbered passage."""
    return F.concat(
        F.lit("ID "), rank.cast("string"), F.lit(": "), id_.cast("string"),
        F.lit("\nCase ID: "), case_id.cast("string"),
        F.lit("\nContent: "), text,
    )


def numbered_block(rank: Column, text: Column) -> Column:
    """One passage under its number."""
    return F.concat(F.lit("[Document "), rank.cast("string"), F.lit("]\n"), text)


def cited_block(id_: Column, case_id: Column, text: Column) -> Column:
    """One passage behind its ids."""
    return F.concat(
        F.lit("[ID: "), id_.cast("string"), F.lit(", Case ID: "), case_id.cast("string"), F.lit("]: "), text
    )


def relevant(hits: DataFrame, least: float) -> DataFrame:
    """The hits whose score reaches ``least``; ranks keep their gaps."""
    return hits.where(F.col("score") >= least)


def hit_record(case_id: Column, id_: Column, language: Column, text: Column) -> Column:
    """JSON record of a hit with the beginning of its text."""
    return F.to_json(
        F.struct(
            F.coalesce(case_id.cast("string"), F.lit("N/A")).alias("Case"),
            F.coalesce(id_.cast("string"), F.lit("N/A")).alias("ID"),
            F.coalesce(language, F.lit("N/A")).alias("language"),
            excerpt(F.coalesce(text, F.lit(""))).alias("excerpt"),
        )
    )


def assemble(
    hits: DataFrame, block: Column, separator: str = BLOCK_SEPARATOR, source: Column | None = None
) -> DataFrame:
    """query_id, context text and the number of sources, blocks in rank order.

    With ``source``, ``sources`` is the list of that value of every block instead.
    """
    values = [F.col("rank"), block.alias("b")] + ([] if source is None else [source.alias("s")])
    ordered = F.array_sort(F.collect_list(F.struct(*values)))
    return (
        hits.groupBy("query_id")
        .agg(ordered.alias("_o"))
        .select(
            "query_id",
            F.array_join(F.col("_o.b"), separator).alias("context"),
            (F.size("_o") if source is None else F.col("_o.s")).alias("sources"),
        )
    )


def document_prompt(question: Column, context: Column) -> Column:
    """Prompt around numbered documents."""
    return F.concat(
        F.lit("Answer from these documents only; if they do not tell, say that you lack the information.\n\n"),
        context,
        F.lit("\n\nQuestion: "), question,
        F.lit("\n\nAnswer:"),
    )


def chat_messages(question: Column, context: Column) -> Column:
    """array<struct<role,content>>: a system message with the context, then the question."""
    system = F.concat(
        F.lit("You assist with research on stored cases. Use this context to answer.\nCONTEXT:\n"),
        context,
        F.lit("\nSay so if it holds nothing relevant, and cite the Case ID of every claim."),
    )

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(message("system", system), message("user", question))


def rag_prompt(question: Column, context: Column) -> Column:
    """Prompt text around a context."""
    return F.concat(
        F.lit("Answer the question from the context below. If it is not covered, say so.\n\n"),
        F.lit("CONTEXT:\n"), context,
        F.lit("\n\nQUESTION: "), question,
        F.lit("\n\nCite the case ID of every passage you use.\n\nANSWER:"),
    )


def join_hot(
    left: DataFrame, right: DataFrame, key: str, hot: Column, spread: Column
) -> DataFrame:
    """Inner join with a right side that is unique by ``key`` and has hot keys.

    ``hot`` marks the right rows whose keys occur very often on the left; the
    caller proves that they are few, and they are broadcast.  All other keys
    go through a shuffle join, while the left rows already matched are spread
    by ``spread`` over the partitions with keys that match nothing.
    """
    values = [c for c in right.columns if c != key]
    few = right.where(hot).select(key, F.struct(*values).alias("_hot"))
    rest = right.where(~hot).select(F.col(key).alias("_key"), F.struct(*values).alias("_cold"))
    probe = F.when(F.col("_hot").isNull(), F.col(key)).otherwise(
        F.concat(F.lit("\u0000"), spread.cast("string"))
    )
    return (
        left.join(F.broadcast(few), key, "left")
        .withColumn("_key", probe)
        .join(rest, "_key", "left")
        .withColumn("_v", F.coalesce("_hot", "_cold"))
        .where(F.col("_v").isNotNull())
        .select(*left.columns, *[F.col("_v")[c].alias(c) for c in values])
    )


def extractive_summary(corpus: DataFrame, keep: int = 2, hot_bytes: int = HIT_BYTES) -> DataFrame:
    """The ``keep`` sentences per text with the highest mean IDF, in text order.

    ``corpus`` has id and text.  Returns id, sentence_no (from 1), sentence and
    score.  Sentences without a token are never chosen.

    The weights of the most frequent terms, ``hot_bytes`` of them at most, are
    sent to the words, which are summed up per sentence where they are.  Only
    words of the rarer terms, if there are any, are shuffled.
    """
    spark = corpus.sparkSession
    split = corpus.select("id", F.posexplode(sentences(F.col("text"))).alias("p", "sentence"))
    split = split.select("id", (F.col("p") + 1).alias("sentence_no"), strip(F.col("sentence")).alias("sentence"))
    words = split.select("id", "sentence_no", F.explode(tokens(F.col("sentence"))).alias("term"))
    n = corpus.agg(F.count(F.lit(1))).scalar()
    frequency = (
        corpus.select(F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .withColumn("idf", F.log(n / F.col("df")))
    )
    folder = shared_folder(spark, "frequency")
    frequency.write.parquet(folder)
    frequency = spark.read.schema(frequency.schema).parquet(folder)
    least, rarer = _least_hot(frequency, hot_bytes)
    hot = F.broadcast(frequency.where(F.col("df") >= least).select("term", "idf"))
    place, sums = ["id", "sentence_no"], (F.sum("idf").alias("idf"), F.count(F.lit(1)).alias("words"))
    if rarer:
        met = words.join(hot, "term", "left").withColumn("term", F.when(F.col("idf").isNull(), F.col("term")))
        folder = shared_folder(spark, "sums")
        met.groupBy(*place, "term").agg(*sums).write.parquet(folder)
        stored = spark.read.parquet(folder)
        rare = stored.drop("idf").join(frequency.where(F.col("df") < least).select("term", "idf"), "term")
        rare = rare.select(*place, (F.col("words") * F.col("idf")).alias("idf"), "words")
        weighed = stored.where(F.col("term").isNull()).select(*place, "idf", "words").unionByName(rare)
        total = weighed.groupBy(*place).agg(F.sum("idf").alias("idf"), F.sum("words").alias("words"))
    else:
        total = words.join(hot, "term").groupBy(*place).agg(*sums)
    scores = total.select(*place, F.round(F.col("idf") / F.col("words"), 9).alias("score"))
    best = top_k(scores, ["id"], [F.desc("score"), F.col("sentence_no")], keep).drop("rank")
    return best.join(split, place).select("id", "sentence_no", "sentence", "score")


def _least_hot(frequency: DataFrame, most: int) -> tuple[int, bool]:
    """From which document frequency on terms take ``most`` bytes together, and whether there are others.

    There are few different frequencies: as many as would need half the square of their number of words.
    """
    size = F.sum(F.octet_length("term") + F.lit(64)).alias("bytes")
    held, least = 0, None
    for r in frequency.groupBy("df").agg(size).orderBy(F.desc("df")).collect():
        held += r.bytes
        if held > most:
            return (r.df + 1 if least is None else least), True
        least = r.df
    return least or 0, False


# Terms are weighed by buckets of their digests, so that the weights are a table of fixed size.
TERM_BUCKETS = 1 << 16
# Sentences with fewer words count less.
FULL_SENTENCE = 8
# What a sentence's own score counts beside its likeness to those chosen.
OWN_SHARE = 0.7


def term_bucket(term: Column, buckets: int = TERM_BUCKETS) -> Column:
    return (F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def diverse_summary(corpus: DataFrame, keep: int = 2, own: float = OWN_SHARE) -> DataFrame:
    """``keep`` sentences per text that say much and differ from each other, in text order.

    A sentence scores the mean IDF of its words, more at the beginning of a
    text (by 1 + 1 / its number) and less below ``FULL_SENTENCE`` words.
    Sentences are chosen by maximal marginal relevance: ``own`` times the
    score, less the rest times the likeness (Jaccard of the words) to a chosen
    sentence, in parts of the best score.  Texts are split and tokenised once
    and stored as numbers; document frequencies combine in the tasks, and
    sentences are chosen where they are, so no word is shuffled.

    ``corpus`` has id and text.  Returns id, sentence_no (from 1), sentence and
    score.  Sentences without a word are never chosen; a null text has none.
    """
    spark = corpus.sparkSession
    folder = shared_folder(spark, "sentences")
    split = corpus.select("id", F.transform(sentences(F.col("text")), strip).alias("sentences"))
    coded = split.withColumn(
        "words", F.transform("sentences", lambda s: F.transform(tokens(s), lambda t: term_bucket(t)))
    )
    coded.write.parquet(folder)
    stored = spark.read.schema(coded.schema).parquet(folder)
    found = stored.select(F.explode(F.array_distinct(F.flatten("words"))).alias("bucket"))
    # At most TERM_BUCKETS rows.
    counts = found.groupBy("bucket").agg(F.count(F.lit(1)).alias("df")).collect()
    idf = np.zeros(TERM_BUCKETS)
    n = stored.count()
    for r in counts:
        idf[r.bucket] = np.log(n / r.df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers, texts, scores = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("id", "sentences", "words"))
            for id_, said, words in zip(*columns):
                for p, score in chosen_sentences(words or [], idf, keep, own):
                    ids.append(id_)
                    numbers.append(p + 1)
                    texts.append(said[p])
                    scores.append(score)
            yield pa.record_batch(
                [pa.array(ids, batch.schema.field("id").type), pa.array(numbers, pa.int32()),
                 pa.array(texts, pa.string()), pa.array(scores, pa.float64())],
                names=["id", "sentence_no", "sentence", "score"],
            )

    kind = stored.schema["id"].dataType.simpleString()
    return stored.mapInArrow(run, f"id {kind}, sentence_no int, sentence string, score double")


def chosen_sentences(words: list, idf: np.ndarray, keep: int, own: float) -> list[tuple[int, float]]:
    """Places and scores of the sentences chosen, in text order."""
    sets = {p: frozenset(w) for p, w in enumerate(words) if w}
    score = {
        p: round(float(idf[words[p]].mean()) * (1 + 1 / (p + 1)) * min(1, len(words[p]) / FULL_SENTENCE), 9)
        for p in sets
    }
    best = max(score.values(), default=0.0)
    like = dict.fromkeys(sets, 0.0)
    taken: list[int] = []
    while len(taken) < keep and len(taken) < len(sets):
        left = [p for p in sets if p not in taken]
        pick = max(left, key=lambda p: (round(own * score[p] - (1 - own) * like[p] * best, 9), -p))
        taken.append(pick)
        for p in left:
            like[p] = max(like[p], len(sets[p] & sets[pick]) / len(sets[p] | sets[pick]))
    return [(p, score[p]) for p in sorted(taken)]


def drop_exact_duplicates(corpus: DataFrame) -> DataFrame:
    """One row per distinct text: the lowest id and the number of copies.

    Texts are compared by digest, so only ids and digests are shuffled, and
    copies combine before the shuffle however many there are.
    """
    return (
        corpus.groupBy(F.sha2("text", 256).alias("_digest"))
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
        .drop("_digest")
    )
