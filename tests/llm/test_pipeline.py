"""The pipeline's stages against what each has to do with its own input."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
import pytest
from conftest import SMALL, ROOT
from pyspark.sql import functions as F

import __spark_entry__ as entry
from casewright.llm import decontamination, pii, repetition, simhash
from casewright.session import shared_folder


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        folder = shared_folder(spark, f"test-{name}")
        stage(spark, out[-1], SMALL).write.parquet(folder)
        out.append(spark.read.parquet(folder))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns(steps):
    for df in steps[1:-1]:
        assert sorted(df.columns) == sorted(steps[0].columns)


def test_quality_and_duplicates(steps):
    assert ids(steps[1]) == ids(repetition.judged(steps[0]).where("kept"))
    found = simhash.near_duplicates(steps[1]).collect()
    assert ids(steps[2]) == {r.component_id for r in found}
    assert steps[2].count() == len(ids(steps[2]))


def test_contamination_goes(spark, steps):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    found = {r.doc_id for r in decontamination.contaminated_passages(steps[2], benchmark).collect()}
    assert ids(steps[3]) == ids(steps[2]) - found


def test_private_data_is_masked(steps):
    before = {r.doc_id: r.text for r in steps[3].collect()}
    after = {r.doc_id: r for r in steps[4].collect()}
    assert set(after) == set(before)
    found = {r.doc_id: r.spans for r in pii.find_private(steps[3]).collect()}
    for k, r in after.items():
        assert r.n_chars == len(r.text)
        assert (r.text == before[k]) == (not found[k])
    assert not any(re.search(r"@mail[0-9]+\.example\.com", r.text) for r in after.values())


def test_run_is_the_chain_of_stages(spark, steps):
    ran = corpus_pipeline.run(spark, SMALL)
    assert ran.columns == steps[-1].columns
    tokens = steps[-1].groupBy("doc_id").agg(F.sum("length")).collect()
    assert Counter(map(tuple, ran.groupBy("doc_id").agg(F.sum("length")).collect())) == Counter(map(tuple, tokens))


def test_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names


def test_nothing_else_imports_the_subpackage():
    for f in [*ROOT.glob("casewright/**/*.py"), *ROOT.glob("tests/*.py"), ROOT / "bench.py"]:
        if "llm" not in f.parts:
            assert "casewright.llm" not in f.read_text()
