from __future__ import annotations

import pytest

from conftest import SMALL

# Nulls, empty and blank texts, short and long ones, copies, repeated rows.
ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "one two three"),
    (6, "na " * 400),
    (7, "Ünïcode wörds çà 日本 語　x y " * 30),
    (8, "w" * 50_000),
    (9, " ".join(f"a{k}" for k in range(300))),
    (10, " ".join(f"a{k}" for k in range(300))),
    (10, " ".join(f"a{k}" for k in range(300))),
    (11, " ".join(f"a{k if k != 150 else 'x'}" for k in range(300))),
    (12, "x\n\nx\n y\nx\n" + " ".join(f"b{k}" for k in range(40)) + " " + " ".join(f"b{k}" for k in range(40))),
    (13, "<|endoftext|> it's we'll 1.2.3.4 don't?! a  b\r\n  c"),
    (14, "0" * 30_000 + " @" * 500 + "+" * 500),
    (None, "a row without an id"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with clashing extra columns, over several partitions."""
    rows = [(i, t, "en", "s", 0, 5, 7, "k") for i, t in ODD_TEXTS]
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard int, size long, kind string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def none(documents):
    return documents.where("doc_id < 0")
