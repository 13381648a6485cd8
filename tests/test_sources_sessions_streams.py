from __future__ import annotations

import datetime as dt
import json
import os
import shutil

import pandas as pd
import pytest
from pyspark.sql import functions as F

from casewright import schemas
from casewright.functions import numeric, scoring
from casewright.operators import logs, sessions
from casewright.plans.catalog import QUERIES
from casewright.sources import files, tables
from casewright.streaming import case_stream, jobs


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def case_dir(tmp_path):
    for name, when in (("case_1/invoice_1.pdf", 1000), ("case_1/b.PDF", 2000), ("case_2/c.pdf", 3000),
                       ("notes/d.pdf", 3000), ("case_2/e.txt", 3000)):
        f = tmp_path / "in" / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(name.encode())
        os.utime(f, (when, when))
    return str(tmp_path / "in")


def stamp(seconds):
    return dt.datetime.fromtimestamp(seconds, dt.UTC).strftime("%Y-%m-%dT%H:%M:%S")


def test_incremental_listing(spark, case_dir):
    def names(**kw):
        return sorted(r.path.split("/")[-1] for r in files.list_case_files(spark, case_dir, **kw).collect())

    assert names() == ["b.PDF", "c.pdf", "invoice_1.pdf"]
    assert names(since=stamp(1000)) == ["b.PDF", "c.pdf"]  # exclusive start
    assert names(since=stamp(1000), until=stamp(2000)) == ["b.PDF"]  # inclusive end
    plan = files.list_case_files(spark, case_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "content" not in plan.split("Relation")[0]


def test_binary_and_lines(spark, case_dir, tmp_path):
    got = files.read_binary(spark, [f"{case_dir}/case_1", f"{case_dir}/case_2"], "*.pdf").collect()
    assert sorted(bytes(r.content) for r in got) == [b"case_1/invoice_1.pdf", b"case_2/c.pdf"]
    q = tmp_path / "q.txt"
    q.write_text("  one? \n\n \t\n two\n")
    assert rows(files.read_questions(spark, str(q))) == [("one?",), ("two",)]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, 1)], "id int, processed bigint")
    b = spark.createDataFrame([(2, 2, "x")], "id int, processed bigint, extra string")
    tables.append_evolving(a, path)
    tables.append_evolving(b, path)
    back = tables.read_evolving(spark, path).select("id", "extra", "processed")
    assert rows(back) == [(1, None, 1), (2, "x", 2)]
    tables.overwrite_runs(b.withColumn("extra", F.lit("y")), path)
    assert rows(tables.read_evolving(spark, path).select("id", "extra", "processed")) == [(1, None, 1), (2, "y", 2)]
    once = str(tmp_path / "once")
    tables.create_if_absent(a, once)
    tables.create_if_absent(b, once)
    assert rows(spark.read.parquet(once)) == [(1, 1)]
    plan = tables.run_slice(spark.read.parquet(path), 2)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(processed" in plan


def test_columns_and_watermark(spark):
    df = spark.createDataFrame([(1,)], "Id int")
    assert tables.ensure_columns(df, {"id": "int", "new": "bigint"}).dtypes == [("Id", "int"), ("new", "bigint")]
    now = F.lit("2024-05-06 00:00:00").cast("timestamp")
    some = spark.createDataFrame([(202401020304,), (202301010000,)], "processed bigint")
    assert tables.watermark_start(some, now).first()[0].isoformat() == "2024-01-02T03:04:00"
    assert tables.watermark_start(some.limit(0), now).first()[0].isoformat() == "2024-05-01T00:00:00"
    assert tables.latest_run(some).first()[0] == 202401020304


def test_arithmetic(spark):
    numeric.register_arithmetic(spark)
    got = spark.sql("SELECT add_numbers(10,3), subtract_numbers(10,3), multiply_numbers(10,3), "
                    "divide_numbers(10,3), divide_numbers(1,0)").first()
    assert got[:3] == (13.0, 7.0, 30.0) and got[3] == pytest.approx(10 / 3) and got[4] is None
    df = spark.createDataFrame([("multiply", 5.0, 3.0), ("divide", 1.0, 0.0), ("divide", 1.0, 4.0)], "o string, a double, b double")
    calc = numeric.calculator(F.col("o"), F.col("a"), F.col("b"))
    assert [r[0] for r in df.select(calc).collect()] == [15.0, float("inf"), 0.25]
    with pytest.raises(Exception, match="Unknown operation: power"):
        df.withColumn("o", F.lit("power")).select(calc).collect()


def test_costs(spark):
    one = spark.range(1)
    cost = numeric.token_cost(F.lit(1_000_000), F.lit(500_000), F.lit(7.143), F.lit(21.429))
    more = numeric.token_cost(F.lit(6_000_000), F.lit(4_000_000), F.lit(7.143), F.lit(21.429))
    reserved = numeric.reserved_cost(F.lit(50), F.lit(240), F.lit(2.0))
    a, b, r = one.select(cost, more, reserved).first()
    assert a == pytest.approx(17.8575) and b == pytest.approx(128.574)
    assert r.total_cost == 24000 and r.total_tokens == 2_808_000_000
    assert r.cost_per_million == pytest.approx(8.547, abs=1e-3)


def test_scorers(spark, evaluate):
    answers = [
        "Just figure it out yourself, it's not that hard.",
        "Here are the anomalies I found. They are based in the documentscase_id=50: ...",
        "case 7: INVOICE_TOTAL_MISMATCH, invoice total 1,200.50 (source: case_id case_07)",
    ]
    names = ("word_count_check", "mentions_valuation_docs", "evidence_citations", "uses_detect_anomalies")
    scores = scoring.answer_scores(F.col("c"))
    got = list(zip(*[evaluate(scores[n], c=answers) for n in names], strict=True))
    assert got == [(True, False, 0, False), (True, False, 3, False), (True, True, 5, True)]
    lengths = [" ".join(["w"] * n) for n in (25, 50, 200, 300, 400)]
    assert evaluate(scores["response_length_score"], c=lengths) == [0.5, 1.0, 1.0, 0.5, 0.0]
    assert evaluate(scores["has_code_example"], c=["```x```", "In PYTHON", "no"]) == [True, True, False]
    assert evaluate(scores["word_count_check"], c=["w " * 349, "w " * 350]) == [True, False]


def test_sessions(spark, tmp_path):
    path = str(tmp_path / "s")
    t = dt.datetime(2024, 1, 1)
    first = [(2, "s1", '{"role":"assistant"}', t), (1, "s1", '{"role":"user"}', t)]
    second = [(3, "s1", '{"n":3}', t + dt.timedelta(minutes=1)), (4, "s2", "{}", t)]
    for part in (first, second):
        sessions.append_messages(spark.createDataFrame(part, schemas.SESSION_MESSAGES), path)
    got = [r.message_data for r in sessions.read_session(spark, path, "s1").collect()]
    assert got == ['{"role":"user"}', '{"role":"assistant"}', '{"n":3}']
    assert sessions.read_session(spark, path, "none").count() == 0


def test_prompt(spark):
    history = spark.createDataFrame([(1, 5, "user", "a"), (1, 9, "assistant", "b")], schemas.CONVERSATIONS)
    inputs = spark.createDataFrame([(1, "c"), (2, "d")], "conv_id bigint, text string")
    got = rows(sessions.conversation_prompt(history, "S", inputs))
    assert got == [(1, 0, "system", "S"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 3, "user", "c"),
                   (2, 0, "system", "S"), (2, 1, "user", "d")]


def test_trace_search(spark):
    events = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1), 7, "error", 1.0, '{"k": 3}'), (2, dt.datetime(2024, 1, 2), 8, "view", 2.0, "{}")],
        schemas.EVENTS,
    )
    traces = logs.traces_from_events(events)
    assert logs.search_traces(traces, status="ERROR").count() == 1
    assert logs.search_traces(traces, tags={"kind": "view"}, metadata={"session": "user-8"}).count() == 1
    assert logs.search_traces(traces, until_ms=1704067200000).count() == 0
    stats = logs.duration_stats(traces).first()
    assert (stats.n, stats.avg_ms, stats.spans) == (2, 150.0, 3)
    assert "tags" not in logs.scalar_columns(traces).columns


def write_part(spark, data, schema, folder, n):
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/part{n}.parquet")


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)


def test_stream_sessions_once_each(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    t = dt.datetime(2024, 1, 1)
    write_part(spark, [(1, "a", "x", t), (1, "a", "x", t), (2, "a", "y", t)], schemas.SESSION_MESSAGES, src, 1)
    jobs.append_sessions(stream(spark, src, schemas.SESSION_MESSAGES), out, ck)
    write_part(spark, [(2, "a", "y", t), (3, "a", "z", t)], schemas.SESSION_MESSAGES, src, 2)
    jobs.append_sessions(stream(spark, src, schemas.SESSION_MESSAGES), out, ck)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_stream_sessions_keep_late_messages(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    parts = [[(1, "a", "w", at(12, 0))], [(1, "b", "x", at(11, 0))], [(2, "b", "y", at(11, 30)), (2, "a", "z", at(12, 5))]]
    for n, part in enumerate(parts):
        write_part(spark, part, schemas.SESSION_MESSAGES, src, n)
        jobs.append_sessions(stream(spark, src, schemas.SESSION_MESSAGES), out, str(tmp_path / "ck"))
    got = sorted((r.session_id, r.id) for r in spark.read.parquet(out).collect())
    assert got == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    # A new checkpoint reads everything again, adds nothing and replaces nothing.
    jobs.append_sessions(stream(spark, src, schemas.SESSION_MESSAGES), out, str(tmp_path / "ck2"))
    assert sorted((r.session_id, r.id) for r in spark.read.parquet(out).collect()) == got


def test_new_checkpoint_keeps_the_index(spark, tmp_path):
    src, more, out = (str(tmp_path / n) for n in ("src", "more", "out"))
    schema = "id string, text string, at int"

    def embed(df):
        return df.select("id", "text_hash", "text")

    write_part(spark, [("a", "x", 1), ("b", "y", 1), ("b", "yy", 2)], schema, src, 1)
    jobs.sync_index(stream(spark, src, schema), out, str(tmp_path / "ck"), embed, "at")
    write_part(spark, [("z", "new", 1), ("a", "x2", 1)], schema, more, 1)
    jobs.sync_index(stream(spark, more, schema), out, str(tmp_path / "ck2"), embed, "at")
    assert rows(jobs.current_index(spark, out).select("id", "text")) == [("a", "x2"), ("b", "yy"), ("z", "new")]
    assert spark.read.parquet(out).where("id = 'b'").count() == 1


def test_monitor_counts_late_events(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    schema = schemas.EVENTS.replace("timestamp_ntz", "timestamp")
    event = lambda i, h: (i, dt.datetime(2024, 1, 1, h), 1, "error", 1.0, "{}")
    write_part(spark, [event(1, 10), event(2, 15)], schema, src, 1)
    jobs.monitor(stream(spark, src, schema), out, ck)
    write_part(spark, [event(3, 10), event(4, 15)], schema, src, 2)
    jobs.monitor(stream(spark, src, schema), out, ck)
    got = {r.start.hour: (r.requests, r.late) for r in jobs.newest_windows(spark, out).collect()}
    assert got == {10: (2, 1), 15: (2, 0)}


def test_stream_index_embeds_changes_only(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    schema = "id string, text string"

    def embed(df):
        return df.select("id", "text_hash", F.length("text").alias("size"))

    write_part(spark, [("a", "x"), ("b", "y")], schema, src, 1)
    jobs.sync_index(stream(spark, src, schema), out, ck, embed)
    write_part(spark, [("a", "x"), ("b", "yy"), ("c", "zzz")], schema, src, 2)
    jobs.sync_index(stream(spark, src, schema), out, ck, embed)
    assert spark.read.parquet(out).count() == 4  # a once, b twice, c once
    assert rows(jobs.current_index(spark, out).select("id", "size")) == [("a", 1), ("b", 2), ("c", 3)]


def test_stream_equals_batch_over_several_runs(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    schema = schemas.EVENTS.replace("timestamp_ntz", "timestamp")
    t = dt.datetime(2024, 1, 1, 10, 30)
    one = [(i, t + dt.timedelta(minutes=5 * i), 1, "error" if i % 3 else "view", 1.25 * i, "{}") for i in range(30)]
    two = [(99, t + dt.timedelta(minutes=140), 1, "view", 9.0, "{}")]
    write_part(spark, one, schema, src, 1)
    jobs.monitor(stream(spark, src, schema), out, ck)
    write_part(spark, two, schema, src, 2)
    jobs.monitor(stream(spark, src, schema), out, ck)
    batch = logs.windowed_activity(spark.createDataFrame(one + two, schema))
    assert rows(jobs.newest_windows(spark, out).select(*batch.columns)) == rows(batch)


def test_stream_pages_equal_batch(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    pages = [(1, "<h1>a</h1><p>b"), (2, "<p>c</p>")]
    schema = "page_id bigint, html string"
    write_part(spark, pages, schema, src, 1)
    jobs.extract_pages(stream(spark, src, schema), out, ck)
    got = spark.read.parquet(out).drop("stream", "batch")
    batch = jobs.explode_page_elements(spark.createDataFrame(pages, schema))
    assert rows(got.select(*batch.columns)) == rows(batch)


def test_final_messages(spark):
    data = [("response.output_item.done", ("message", "yes")), ("response.output_item.done", ("call", "no")),
            ("response.created", ("message", "no"))]
    df = spark.createDataFrame(data, "type string, item struct<type:string,content:string>")
    assert rows(sessions.final_messages(df)) == [("yes",)]


def test_message_json(spark):
    df = spark.createDataFrame([("user", 'a"b')], "role string, text string")
    got = df.select(sessions.message_json(F.col("role"), F.col("text"))).first()[0]
    assert json.loads(got) == {"role": "user", "content": 'a"b'}


def test_cases_are_held_until_complete(spark, tmp_path):
    """Files over four runs: out of order, twice, of a role again, and after the case was complete."""
    root, src, ck = (str(tmp_path / n) for n in ("root", "src", "ck"))

    def path(case, name):
        return f"/cases/case_{case}/{name}.pdf"

    element = '{"document": {"elements": [{"id": "x", "type": "text", "content": "of %s"}]}}'
    names = [path(c, n) for c in (1, 2, 3) for n in ("invoice_a", "invoice_b", "declaration_a", "royalty_a")]
    parsed = spark.createDataFrame(
        [(p, element % p, element % p, "en", False, 7) for p in names],
        "path string, parsed_content string, parsed_content_translated string, source_language string, "
        "translation_applied boolean, processed bigint",
    )
    seen: list[str] = []

    def known(session):
        return parsed.where(F.col("path").isin(seen))

    def run(number, *files):
        seen.extend(files)
        write_part(spark, [(f,) for f in files], "path string", src, number)
        case_stream.stream_cases(stream(spark, src, "path string"), known, root, ck)
        waiting = {r.id for r in case_stream.waiting_cases(spark, root).collect()}
        chunks = case_stream.current_chunks(spark, root).collect()
        return waiting, {(r.case_id, r.document_path, r.processed) for r in chunks}, {r.metadata for r in chunks}

    waiting, chunks, _ = run(1, path(1, "declaration_a"), path(2, "invoice_a"), path(3, "royalty_a"), "/x/notes.pdf")
    assert (waiting, chunks) == ({"case_1", "case_2", "case_3"}, set())
    waiting, chunks, _ = run(2, path(1, "invoice_a"), path(2, "scan"), path(3, "invoice_a"))
    assert waiting == {"case_2", "case_3"}
    assert chunks == {("case_1", path(1, n), 1) for n in ("declaration_a", "invoice_a")}
    # A file seen before and a smaller one of its role are no news; a greater one is.
    waiting, chunks, paths = run(3, path(1, "invoice_a"), path(1, "royalty_a"), path(3, "invoice_b"))
    assert waiting == {"case_2", "case_3"}
    assert {c[2] for c in chunks} == {2} and any("royalty_a" in p for p in paths)
    waiting, chunks, paths = run(4, path(3, "declaration_a"))
    assert waiting == {"case_2"}
    assert {(c, n) for c, _, n in chunks} == {("case_1", 2), ("case_3", 3)}
    assert any("case_3/invoice_b" in p for p in paths)
    # A run without files changes nothing.
    case_stream.stream_cases(stream(spark, src, "path string"), known, root, ck)
    assert {r.id for r in case_stream.waiting_cases(spark, root).collect()} == {"case_2"}


def test_one_call_follows_all_cases_of_a_bucket():
    """News are new cases and greater paths; the state of a bucket is what all its cases have."""

    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    def follow(*files):
        frame = pd.DataFrame(files, columns=["id", *case_stream.PATH_COLUMNS], dtype=object)
        out = list(case_stream.follow_cases((0,), iter([frame[:2], frame[2:]]), state))
        return [tuple(r) for f in out for r in f.itertuples(index=False)]

    state = State()
    assert follow(("a", "i1", None, None), ("b", None, None, None), ("a", None, "d1", None)) == [
        ("a", "i1", "d1", None, True),
        ("b", None, None, None, False),
    ]
    assert follow(("a", "i0", None, None), ("b", None, None, None), ("a", None, "d1", None)) == []
    assert follow(("b", "i1", None, None), ("b", "i0", None, None), ("c", None, None, "r1")) == [
        ("b", "i1", None, None, False),
        ("c", None, None, "r1", False),
    ]
    assert state.get == (["a", "b", "c"], ["i1", "i1", None], ["d1", None, None], [None, None, "r1"])


def test_table_stream_reads_a_file_and_a_folder_of_files(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/whole/a.parquet")
    spark.range(3).write.parquet(f"{tmp_path}/whole/b.parquet")
    part = next((tmp_path / "whole" / "b.parquet").glob("part-*.parquet"))
    (tmp_path / "single").mkdir()
    shutil.copy(part, tmp_path / "single" / "a.parquet")

    def rows(folder, out):
        stream = jobs.read_table_stream(spark, f"{tmp_path}/{folder}", "a", "id long")
        jobs.run_available(
            stream, f"{tmp_path}/{out}-checkpoint", lambda df, step: jobs.write_batch(df, step, f"{tmp_path}/{out}")
        )
        return spark.read.parquet(f"{tmp_path}/{out}").count()

    assert rows("whole", "from_folder") == 5
    assert rows("single", "from_file") == spark.read.parquet(str(part)).count()


def test_streamed_tables_may_be_folders_of_files(spark, tmp_path):
    """The index of all documents, that of two runs, and the pages, from tables of several files."""
    text = F.concat(F.lit("blue bolt "), F.col("id"))
    documents = spark.range(12).select(
        F.col("id").alias("doc_id"),
        text.alias("text"),
        F.when(F.col("id") % 2 == 0, "en").otherwise("fr").alias("lang"),
        F.lit("web").alias("source"),
        F.length(text).cast("long").alias("n_chars"),
    )
    pages = spark.range(6).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("<p>page "), F.col("id")).alias("html")
    )
    questions = spark.range(2).select(F.col("id").alias("item_id"), F.lit("a bolt").alias("text"))
    for name, df in (("documents", documents), ("pages", pages), ("benchmark", questions)):
        df.repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")

    def found(name):
        return QUERIES[name](spark, str(tmp_path)).collect()

    assert len(found("context_budget")) == 2 * 10
    assert {r.id for r in found("stream_index_sync")} == set(range(12))
    assert sorted((r.page_id, r.content) for r in found("stream_elements")) == [(i, f"page {i}") for i in range(6)]
