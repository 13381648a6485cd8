"""Offline embeddings and hash codes; Arrow batches in, Arrow batches out."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.functions.text import tokens


def hash_embedding(c: Column, dims: int = 1024) -> Column:
    """Unit-length vector of hashed token counts (array<double>).

    Tokens are found in the JVM and hashed by the first 32 bits of their MD5
    digest; counting and scaling a whole Arrow batch is one numpy call each.
    """

    @F.arrow_udf("array<double>")
    def dense(words: pa.Array) -> pa.Array:
        n = len(words)
        lengths = np.nan_to_num(words.value_lengths().to_numpy(zero_copy_only=False)).astype(
            np.int64
        )
        rows = np.repeat(np.arange(n), lengths)
        # Each different token of the batch is hashed once.
        coded = words.flatten().dictionary_encode()
        bucket = np.array(
            [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % dims for t in coded.dictionary.to_pylist()],
            np.int64,
        )
        flat = rows * dims + bucket[coded.indices.to_numpy(zero_copy_only=False)]
        counts = np.bincount(flat.astype(np.int64), minlength=n * dims).reshape(n, dims)
        norm = np.sqrt((counts * counts).sum(1, keepdims=True))
        unit = np.divide(counts, norm, out=np.zeros(counts.shape), where=norm > 0)
        offsets = np.arange(0, n * dims + 1, dims, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(unit.ravel()))

    return dense(tokens(c))


def plane_table(dims: int, planes: int, seed: int = 7) -> np.ndarray:
    """Normals of random hyperplanes, rounded so that they can be written down exactly."""
    return np.round(np.random.default_rng(seed).standard_normal((dims, planes)), 6)


def plane_codes(vector: Column, dims: int, tables: int = 8, bits: int = 8, seed: int = 7) -> Column:
    """array<int>: one bucket per table from random hyperplanes (Charikar 2002)."""
    planes = plane_table(dims, tables * bits, seed)
    powers = (1 << np.arange(bits)).astype(np.int64)

    @F.arrow_udf("array<int>")
    def code(vectors: pa.Array) -> pa.Array:
        n = len(vectors)
        m = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, dims)
        sides = (m @ planes > 0).reshape(n, tables, bits)
        codes = (sides * powers).sum(2).astype(np.int32)
        offsets = np.arange(0, n * tables + 1, tables, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.ravel()))

    return code(vector)


def tfidf_embedding(df: DataFrame, text: str = "text", dims: int = 1024, out: str = "vector") -> DataFrame:
    """Unit-length TF-IDF vectors with Spark ML's hashing transformer.

    The fitted state is one weight per dimension, whatever the corpus size.
    """
    from pyspark.ml.feature import IDF, HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    counted = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=dims).transform(
        df.withColumn("_tokens", tokens(F.col(text)))
    )
    weighted = IDF(inputCol="_tf", outputCol="_tfidf").fit(counted).transform(counted)
    scaled = Normalizer(inputCol="_tfidf", outputCol="_unit").transform(weighted)
    return scaled.withColumn(out, vector_to_array("_unit")).drop(
        "_tokens", "_tf", "_tfidf", "_unit"
    )
