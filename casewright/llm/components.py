"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.session import shared_folder


def _stored(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour on the smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every smaller neighbour, and the node itself, on the smallest neighbour."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hung = down.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; the root is the least node reachable.

    ``edges`` has long columns a and b, in any order, each edge once or more,
    and no edge from a node to itself.  Rounds are stored in the shared folder
    and repeat until one changes nothing; a node with very many neighbours is
    a key that combines on the map side and splits in the join.
    """
    spark = edges.sparkSession
    now = _stored(edges.select("a", "b").distinct(), shared_folder(spark, "edges"))
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = seen
        stars = _small_star(_large_star(now).distinct()).distinct()
        now = _stored(stars, shared_folder(spark, "edges"))
