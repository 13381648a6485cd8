"""Spelling variants: words one edit apart, found along a trie that is built while it is walked.

The trie is a table of edges (node, first letter, label, child); a node is the
prefix that leads to it, and a label runs on until words part or end, so long
words take few levels.  A level is built by grouping the words that are still
together at their node.  The frontier holds states (word, position, node,
edits).  A state without edits follows its own word and may take any edge that
differs by one replaced letter, or by one letter less; a state with its one
edit needs the edge that spells what is left of its word.  Joined with the
edges level by level, the states that end where a word ends are neighbours.

Only one direction is walked: a replacement towards the greater word, and a
deletion.  The other direction is the same pair seen from its other word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.session import shared_folder

LEAST_LENGTH = 6
LEAST_COUNT = 5
# A form is this many times as frequent as its variant.
FACTOR = 5
DAMAGE = 199
LETTERS = "A-Za-zÀ-ÿ"
# Words per task on the first level, where each meets the most edges.
TASK_WORDS = 20_000
# Nodes of the first two levels have at most 90 letters each: 8,100 edges.
BROADCAST_LEVELS = 2


def folded(word: Column) -> Column:
    """Only A-Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(word.rlike("[À-Þ]"), F.translate(word, upper, upper.lower())).otherwise(F.lower(word))


def damaged(word: Column, doc_id: Column, every: int = DAMAGE) -> Column:
    """The word, or with one letter less where ``every`` divides the checksum of id and word."""
    h = F.crc32(F.concat_ws(":", doc_id.cast("string"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    cut = F.concat(F.substr(word, F.lit(1), at), F.substr(word, at + 2))
    return F.when(doc_id.isNotNull() & (h % every == 0), cut).otherwise(word)


def observed_words(
    documents: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    every: int = DAMAGE,
) -> DataFrame:
    """(word, n): the different words of all whole texts and how often they occur.

    Words are maximal runs of Latin letters, folded, with the planned damage;
    ``least_length`` is checked after it.  A null text has no words, a null
    doc_id has undamaged ones, repeated rows count again, an empty table gives
    no words, and other columns are not looked at.  Words are counted in every
    task before they are shuffled, so a hot word is one row per task.
    """
    # No run that is too short as it stands can become long enough.
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    words = documents.select("doc_id", F.explode(runs).alias("run")).select(
        damaged(folded(F.col("run")), F.col("doc_id"), every).alias("word")
    )
    counts = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least_count)


def common_length(a: Column, b: Column) -> Column:
    """Length of the common prefix of two different texts, the smaller first."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x.eqNullSafe(y))
    return (F.array_position(same, False) - 1).cast("int")


def edges_of(together: DataFrame) -> DataFrame:
    """Edges that leave the nodes of one level.

    The least and the greatest word of a group share what all of it shares.
    ``entry`` is the word that ends at the child, which is the least one.
    """
    ongoing = together.where("size > depth")
    first = F.substr("word", F.col("depth") + 1, F.lit(1)).alias("letter")
    groups = ongoing.groupBy("node", first).agg(
        F.min(F.struct("word", "n")).alias("least"),
        F.max("word").alias("high"),
        F.count("*").alias("words"),
        F.min("size").alias("shortest"),
        F.max("size").alias("longest"),
        F.min("depth").alias("depth"),
    )
    low = F.col("least.word")
    until = F.when(F.col("words") == 1, F.length(low)).otherwise(common_length(low, F.col("high")))
    ends = F.length(low) == F.col("until")
    return groups.withColumn("until", until).select(
        "node",
        "letter",
        F.substr(low, F.col("depth") + 1, F.col("until") - F.col("depth")).alias("label"),
        F.substr(low, F.lit(1), F.col("until")).alias("child"),
        "until",
        "words",
        "shortest",
        "longest",
        F.when(ends, low).alias("entry"),
        F.when(ends, F.col("least.n")).alias("entry_n"),
    )


def descended(together: DataFrame, edges: DataFrame) -> DataFrame:
    """Words that share their child with others, at that child."""
    shared = edges.where("words > 1").select("node", "letter", "child", "until")
    at = together.where("size > depth").withColumn("letter", F.substr("word", F.col("depth") + 1, F.lit(1)))
    return at.join(shared, ["node", "letter"]).select(
        "word", "n", "size", F.col("child").alias("node"), F.col("until").alias("depth")
    )


def first_edits(together: DataFrame, edges: DataFrame) -> DataFrame:
    """States that make their edit on an edge of the level."""
    word, depth, label = F.col("word"), F.col("depth"), F.col("label")
    steps = F.length(label)
    here = F.substr(word, depth + 1, steps)
    more = F.substr(word, depth + 1, steps + 1)
    longer = F.length(more) > steps

    def holds(size: Column) -> Column:
        return (size >= F.col("shortest")) & (size <= F.col("longest"))

    replaced = (
        holds(F.col("size"))
        & (label > here)
        & (F.length(here) == steps)
        & ((steps == 1) | (F.levenshtein(here, label, 1) == 1))
    )
    # A letter dropped behind an edge that is spelt in full is dropped on the next edge,
    # unless the word ends there.
    last = F.col("entry").isNotNull() & (F.col("size") == depth + steps + 1)
    dropped = (
        holds(F.col("size") - 1) & longer & ((here != label) | last) & (F.levenshtein(more, label, 1) == 1)
    )
    ways = F.filter(
        F.array(F.when(replaced, depth + steps), F.when(dropped, depth + steps + 1)),
        lambda x: x.isNotNull(),
    )
    return together.join(edges, "node").select(*ARRIVED, F.explode(ways).alias("position"))


def spelt_out(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States with their edit made, along the edge that spells the next letters."""
    ahead = states.withColumn("letter", F.substr("word", F.col("position") + 1, F.lit(1)))
    steps = F.length("label")
    # What is left of the word behind the edge has to fit the words below it.
    size = F.col("until") + F.col("size") - F.col("position") - steps
    return (
        ahead.join(edges, ["node", "letter"])
        .where(F.substr("word", F.col("position") + 1, steps) == F.col("label"))
        .where((size >= F.col("shortest")) & (size <= F.col("longest")))
        .select(*ARRIVED, (F.col("position") + steps).alias("position"))
    )


ARRIVED = ("word", "n", "size", "child", "words", "entry", "entry_n")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of every two words one inserted, deleted or replaced letter apart.

    ``words`` has different words with their counts.  Each pair comes once, the
    longer or smaller word first.  No words give no pairs.  Every level is
    written to the shared folder, so a lost executor costs one level at most.
    Joins on the first two levels send edges (at most 8,100) to all tasks;
    below them a node has a small share of the words, and joins that are
    uneven all the same are split by the adaptive skew join.
    """
    spark = words.sparkSession
    folder = shared_folder(spark, "spelling")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    start = words.select(
        "word", "n", F.length("word").alias("size"), F.lit("").alias("node"), F.lit(0).alias("depth")
    )
    together = stored(start.repartition(1 + words.count() // TASK_WORDS, "word"), "words-start")
    states, levels = None, 0
    while levels == 0 or not together.isEmpty():
        edges = stored(edges_of(together), f"edges-{levels}")
        near = F.broadcast(edges) if levels < BROADCAST_LEVELS else edges
        moves = first_edits(together, near)
        if states is not None:
            moves = moves.unionByName(spelt_out(states, near))
        moves = stored(moves, f"moves-{levels}")
        states = moves.where("words > 1 AND position < size").select(
            "word", "n", "size", "position", F.col("child").alias("node")
        )
        together = stored(descended(together, near), f"words-{levels}")
        levels += 1
    arrived = spark.read.parquet(*[f"{folder}/moves-{i}" for i in range(levels)])
    return arrived.where("position = size AND entry IS NOT NULL").select(
        "word", "n", F.col("entry").alias("near"), F.col("entry_n").alias("near_n")
    )


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of (word, form): the last word reached by following forms.

    Forms lead to ever more frequent words, by ``FACTOR`` at least, so chains
    are short; every round doubles the steps taken.
    """
    spark = forms.sparkSession
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = now.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        folder = shared_folder(spark, "roots")
        moved.write.parquet(folder)
        stored = spark.read.parquet(folder)
        now = stored.select("word", "root")
        if stored.where("moved").isEmpty():
            return now


def spelling_variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of (word, n).

    A word's form is its near word of largest n (ties: the smallest in code
    point order) if that n is at least ``factor`` times its own; its root is
    where following forms ends, itself without a form.
    """
    pairs = near_pairs(words)
    both = pairs.unionByName(
        pairs.select(
            F.col("near").alias("word"),
            F.col("near_n").alias("n"),
            F.col("word").alias("near"),
            F.col("n").alias("near_n"),
        )
    )
    best = both.groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    top = -F.col("best.less")
    formed = top >= F.col("n") * factor
    folder = shared_folder(words.sparkSession, "forms")
    best.select(
        "word", "n_near", F.when(formed, F.col("best.near")).alias("form"), F.when(formed, top).alias("form_n")
    ).write.parquet(folder)
    forms = words.sparkSession.read.parquet(folder)
    roots = roots_of(forms.where("form IS NOT NULL"))
    return (
        words.join(forms, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )


def stored_words(words: DataFrame) -> DataFrame:
    """Write the counted words to the shared folder: they are read level by level."""
    folder = shared_folder(words.sparkSession, "words")
    words.write.parquet(folder)
    return words.sparkSession.read.parquet(folder)
