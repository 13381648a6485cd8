from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casewright.functions import language, text

C = F.col("c")
few = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
prose = st.lists(
    st.text(
        alphabet=st.sampled_from("aB9_-é. \t\n\r  \u001c!?,ß"), max_size=40
    ),
    min_size=1,
    max_size=40,
)


def py_clean(t: str) -> str:
    joined = re.sub(r"(\w)-\s*\n\s*(\w)", r"\1\2", t)
    return " ".join(joined.split())


def test_clean_text(evaluate):
    given_ = ["docu-\nments", "a \n b\t c", "a-\nb-\nc", "a  b", ""]
    assert evaluate(text.clean_text(C), c=given_) == ["documents", "a b c", "ab- c", "a b", ""]


@few
@given(prose)
def test_clean_text_follows_unicode(evaluate, texts):
    assert evaluate(text.clean_text(C), c=texts) == [py_clean(t) for t in texts]


@few
@given(prose)
def test_strip_and_word_count(evaluate, texts):
    assert evaluate(text.strip(C), c=texts) == [t.strip() for t in texts]
    assert evaluate(text.word_count(C), c=texts) == [len(t.split()) for t in texts]


def py_windows(t: str, size: int, overlap: int):
    return [(i, t[i : i + size]) for i in range(0, len(t), size - overlap)]


def test_fixed_chunks(evaluate):
    lengths = (950, 1100, 0, 1, 450, 451)
    got = evaluate(text.fixed_chunks(C), c=["x" * n for n in lengths])
    shapes = [[(w["start"], len(w["text"])) for w in ws] for ws in got]
    assert shapes[:3] == [[(0, 500), (450, 500), (900, 50)], [(0, 500), (450, 500), (900, 200)], []]
    assert shapes == [[(i, len(s)) for i, s in py_windows("x" * n, 500, 50)] for n in lengths]
    emoji = evaluate(text.fixed_chunks(C, 3, 1), c=["a😀bcd"])[0]
    assert [w["text"] for w in emoji] == ["a😀b", "bcd", "d"]
    with pytest.raises(ValueError):
        text.fixed_chunks(C, 50, 50)


def test_sentence_chunks(evaluate):
    got = evaluate(text.sentence_chunks(C), c=["A b. C d! E", "", "x. " * 6])
    assert got == [["A b. C d! E"], [""], ["x. x. x. x. x.", "x. "]]


@few
@given(prose)
def test_sentence_chunks_property(evaluate, texts):
    def expected(t):
        parts = re.split(r"(?<=[.!?])\s+", t)
        return [" ".join(parts[i : i + 2]) for i in range(0, len(parts), 2)]

    assert evaluate(text.sentence_chunks(C, 2), c=texts) == [expected(t) for t in texts]


def py_pack(t: str, sep: str, budget: int):
    out, used = [], 0
    for p in (q.strip() for q in t.split(sep)):
        if not p:
            continue
        if not out or used + len(p) // 4 > budget:
            out.append([p])
            used = len(p) // 4
        else:
            out[-1].append(p)
            used += len(p) // 4
    return [sep.join(ps) for ps in out]


def test_paragraph_chunks(evaluate):
    texts = ["aaaa\n\nbbbbbbbb\n\ncccc\n\ndddd\n\n\n\n" + "e" * 40, "", "one", "\n\n \n\n"]
    got = evaluate(text.paragraph_chunks(C, budget=2), c=texts)
    assert got == [py_pack(t, "\n\n", 2) for t in texts]
    # whole paragraphs only: nothing is lost or cut
    assert "".join(got[0]).replace("\n", "") == texts[0].replace("\n", "")


def test_estimates_and_excerpts(evaluate):
    long = "This sentence has some characters, and it is repeated many times over. " * 100
    assert evaluate(text.token_estimate(C), c=["Hello, world!", long]) == [3, len(long) // 4]
    assert evaluate(text.excerpt(C, 3), c=["abcdef", None, "ab"]) == ["abc...", "N/A", "ab..."]
    assert evaluate(text.preview(C, 3), c=["a\nbc"]) == ["a\\nb"]
    assert evaluate(text.nonblank_lines(C), c=[" a \n\n \n b\n"]) == [["a", "b"]]


def test_language_agrees_with_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    detected = docs.select("lang", language.detect_language(F.col("text")).alias("d"))
    right, n = detected.agg(F.count_if(F.col("lang") == F.col("d")), F.count("*")).first()
    assert right / n > 0.9
