"""Language of texts by character n-grams: naive Bayes, counted and scored by Spark.

The model is a table (gram, language, weight): the logarithm of how much more
often a language has the gram than all do on average, with one added to every
count.  A text's score for a language is the sum over its grams; what no
sampled text has says nothing.  Counting is one aggregate and scoring one
join; the model is bounded by the number of different grams kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright.functions.text import let
from casewright.session import shared_folder

GRAM = 3
# Texts counted per language, chosen by the digest of their id.
SAMPLE_TEXTS = 20_000
# The grams of the model: those that most sampled texts have.
MOST_GRAMS = 20_000
# Weights and scores are compared after rounding, so that no order of summation tells.
DIGITS = 6


def grams(text: Column, size: int = GRAM) -> Column:
    """The different character n-grams of a text in lower case; runs of other than letters are one space."""
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"\P{L}+", " ")), F.lit(" "))

    def runs(letters: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(letters) - size)
        return F.transform(starts, lambda i: F.concat(*[F.get(letters, i + j) for j in range(size)]))

    return let(
        plain,
        lambda t: F.array_distinct(
            # A substring counts its characters from the start of the text: that is quadratic, an array is not.
            F.when(F.length(t) >= size, let(F.split(t, ""), runs)).otherwise(F.array().cast("array<string>"))
        ),
    )


def sampled(labelled: DataFrame, texts: int = SAMPLE_TEXTS) -> DataFrame:
    """At most ``texts`` rows of every language of (id, text, lang), by the least digests of their ids."""
    order = Window.partitionBy("lang").orderBy(F.md5(F.col("id").cast("string")), "id")
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return known.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= texts).drop("_n")


def gram_counts(sample: DataFrame, size: int = GRAM) -> DataFrame:
    """(gram, lang, texts): how many texts of a language have a gram."""
    each = sample.select("lang", F.explode(grams(F.col("text"), size)).alias("gram"))
    return each.groupBy("gram", "lang").agg(F.count(F.lit(1)).alias("texts"))


def fit(sample: DataFrame, size: int = GRAM, most: int = MOST_GRAMS) -> DataFrame:
    """(gram, lang, weight) of the ``most`` grams that most texts have.

    A gram's weight for a language is the logarithm of its smoothed share of
    that language's texts, less the mean over all languages, so that a gram
    that says nothing adds nothing.
    """
    counts = gram_counts(sample, size)
    totals = sample.groupBy("lang").agg(F.count(F.lit(1)).alias("total"))
    kept = (
        counts.groupBy("gram")
        .agg(F.sum("texts").alias("all"))
        .orderBy(F.desc("all"), "gram")
        .limit(most)
        .select("gram")
    )
    # Every kept gram meets every language: languages are a handful.
    pairs = kept.select("gram", F.explode(F.lit([r.lang for r in totals.select("lang").collect()])).alias("lang"))
    filled = pairs.join(counts, ["gram", "lang"], "left").join(F.broadcast(totals), "lang")
    share = F.log((F.coalesce("texts", F.lit(0)) + 1) / (F.col("total") + 2))
    mean = F.avg("share").over(Window.partitionBy("gram"))
    return filled.withColumn("share", share).select(
        "gram", "lang", F.round(F.col("share") - mean, DIGITS).alias("weight")
    )


def detect(corpus: DataFrame, model: DataFrame, size: int = GRAM) -> DataFrame:
    """(id, lang, score) of every row of (id, text): the language of greatest score.

    Ties go to the first code.  A text without a known gram has no language;
    an empty table gives no rows; ids are taken to be unique.  The model's grams are a bounded table that
    every task gets; a text's grams meet it where they are, and only one row
    per text is shuffled.
    """
    folder = shared_folder(corpus.sparkSession, "model")
    model.write.parquet(folder)
    known = corpus.sparkSession.read.schema(model.schema).parquet(folder)
    langs = sorted(r.lang for r in known.select("lang").distinct().collect())
    # A column per language, so that a gram of a text meets one row.
    names = {f"_{i}": lang for i, lang in enumerate(langs)}
    wide = known.groupBy("gram").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(F.when(F.col("lang") == v, F.col("weight"))).alias(n) for n, v in names.items()]
    )
    each = corpus.select("id", F.explode(grams(F.col("text"), size)).alias("gram"))
    scores = each.join(F.broadcast(wide.drop("_rows")), "gram").groupBy("id").agg(
        F.count(F.lit(1)).alias("_grams"), *[F.sum(n).alias(n) for n in names]
    )
    scored = [
        F.when(F.col(n).isNotNull(), F.struct((-F.round(n, DIGITS)).alias("less"), F.lit(v).alias("lang")))
        for n, v in names.items()
    ]
    kind = f"struct<less:double,lang:{model.schema['lang'].dataType.simpleString()}>"
    best = scores.select("id", F.array_min(F.array(*scored).cast(f"array<{kind}>")).alias("best"))
    best = best.select("id", F.col("best.lang").alias("lang"), (-F.col("best.less")).alias("score"))
    return corpus.select("id").join(best, "id", "left")
