"""Every registered query against its SQL statement, and what the plans look like."""

from __future__ import annotations

import re
import sys

import pytest
from conftest import ROOT, SMALL

sys.path.insert(0, str(ROOT / "tools"))
import compare as tool  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

# The text operators have their own tests.
QUERIES = {n: q for n, q in entry.queries().items() if not n.startswith("op") and n != "pipeline"}
ORACLES = {n: q for n, q in entry.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return tool.connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    _, _, verdict = tool.compare(spark, duck, SMALL, name, QUERIES[name], ORACLES.get(name))
    assert verdict in ("ok", "rows only"), verdict


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["case_id", "anomaly_rule"] and df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"embed_tfidf"}


def test_rows_are_embedded_once(spark):
    # Searches of the stored index read stored vectors; a search of filtered texts embeds them once.
    assert not re.search(r"ArrowEvalPython", plan(spark, "hybrid_rrf"))
    assert len(re.findall(r"ArrowEvalPython", plan(spark, "search_records"))) == 1


def plan(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["chunks_enriched", "case_rollup", "clean_text", "chunk_paragraph", "score_answers", "parse_elements",
             "translation_outcome", "detect_language", "recover_json"]
)
def test_extraction_stays_in_the_jvm(spark, name):
    text = plan(spark, name)
    assert not re.search(r"EvalPython|MapInArrow|MapInPandas|FlatMap", text)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("stream_", "sink_", "session_append", "pipeline_", "index_"))])
def test_no_cross_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_rules_scan_once(spark):
    assert not re.search(r"[-+ ]Union\b", re.sub(r"\{.*?\}", "", plan(spark, "anomalies_all")))


def test_scans_read_only_the_needed_columns(spark):
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in plan(spark, "latest_run")
    assert "ReadSchema: struct<conv_id:bigint,turn:bigint,role:string,text:string>" in plan(
        spark, "last_message"
    )
    assert "html" not in plan(spark, "chunk_stats") and "lang" not in plan(spark, "chunk_stats")


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(label), EqualTo(label,3)" in plan(spark, "knn_filtered")
    assert "GreaterThanOrEqual(label,5)" in plan(spark, "knn_range_filtered")
