from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from casewright import schemas
from casewright.functions.fields import FIELD_TYPES
from casewright.operators import batch, cases, merge, rules

ALL = ", ".join(f"{n} {t}" for n, t in FIELD_TYPES.items())


def field_rows(spark, *rows):
    data = [tuple(r.get(n) for n in ("case_id", *FIELD_TYPES)) for r in rows]
    return spark.createDataFrame(data, f"case_id string, {ALL}")


def test_rules(spark):
    rows = field_rows(
        spark,
        {"case_id": "a", "invoice_total": 100.0, "declaration_invoice_total": 110.0},
        {"case_id": "b", "declaration_invoice_total": 100.0, "declaration_tax_A": 5.0,
         "declaration_VAT": 21.0, "declaration_total": 127.0},
        {"case_id": "c", "royalty_percentage": 5.0},
        {"case_id": "d", "invoice_total": 100.0, "declaration_invoice_total": 100.0,
         "declaration_total": 100.1, "declaration_tax_B": 0.1},
    )
    got = {(r.case_id, r.anomaly_rule) for r in rules.detect_anomalies(rows).collect()}
    assert got == {
        ("a", "INVOICE_TOTAL_MISMATCH"), ("b", "DECLARATION_TOTAL_MISMATCH"), ("c", "ROYALTY_MISMATCH"),
    }
    one = rules.detect_anomalies(rows, "ROYALTY_MISMATCH").collect()
    assert [r.case_id for r in one] == ["c"]
    assert rules.detect_anomalies(rows, "UNKNOWN").count() == 0
    loose = {r.case_id for r in rules.detect_anomalies(rows, tolerance=10.0).collect()}
    assert loose == {"c"}

    rows.unionByName(rows).createOrReplaceTempView("rule_rows")
    rules.register_detect_anomalies(spark, "rule_rows", "find_anomalies")
    same = {(r.case_id, r.anomaly_rule) for r in spark.sql("SELECT * FROM find_anomalies()").collect()}
    assert same == got
    assert spark.sql("SELECT * FROM find_anomalies('nope')").count() == 0
    assert spark.sql("SELECT * FROM find_anomalies(anomaly_type => 'ROYALTY_MISMATCH')").count() == 1


def parsed_doc(path, *elements, lang="en"):
    body = json.dumps({"document": {"elements": list(elements)}})
    return (path, body, 1, body, lang, False)


def test_rollup_takes_the_first_value_in_path_order(spark):
    def invoice(amount):
        cells = "".join(f"<td>{c}</td>" for c in ["", "", "", "", "", amount, "eur"])
        return {"type": "table", "content": f"<table><tr>{cells}</tr></table>"}

    docs = [
        parsed_doc("/v/case_1/invoice_b.pdf", invoice("2")),
        parsed_doc("/v/case_1/invoice_a.pdf", invoice("bad")),
        parsed_doc("/v/case_1/invoice_c.pdf", invoice("3")),
        parsed_doc("/v/case_1/royalty_1.pdf", {"type": "text", "content": "4 %"}),
        parsed_doc("/v/case_2/other.pdf", {"type": "text", "content": "4 %"}),
    ]
    df = spark.createDataFrame(docs, schemas.PARSED).repartition(5)
    got = {r.case_id: (r.invoice_total, r.royalty_percentage) for r in cases.case_rollup(df).collect()}
    assert got == {"case_1": (2.0, 4.0), "case_2": (None, None)}


def test_enriched_chunks_keep_chunks_without_a_case(spark):
    docs = spark.createDataFrame(
        [parsed_doc("/v/case_9/x.pdf", {"type": "text", "content": "a-\nb"})], schemas.PARSED
    )
    none = spark.createDataFrame([], schemas.CASES)
    (row,) = cases.enriched_chunks(docs, none).collect()
    assert (row.id, row.text, row.metadata) == ("case_9_x_", "ab", "")
    columns = [c.split()[0] for c in schemas.CHUNKS.split(", ")]
    assert cases.enriched_chunks(docs, none).columns == columns


def test_hot_case(spark):
    """One case with most documents gives the same rows as any other."""
    body = {"id": "t", "type": "text", "content": "x"}
    docs = [parsed_doc(f"/v/case_{0 if i % 3 else i}/d_{i}.pdf", body) for i in range(600)]
    df = spark.createDataFrame(docs, schemas.PARSED)
    chunks = cases.enriched_chunks(df, spark.createDataFrame([], schemas.CASES))
    assert chunks.count() == 600 and chunks.select("id").distinct().count() == 600


def test_quarantine(spark):
    row = "".join(f"<td>{c}</td>" for c in ["Total", "", "1,5", "eur"])
    doc = {"type": "table", "content": f"<table><tr><td>h</td></tr><tr>{row}</tr></table>"}
    df = spark.createDataFrame([parsed_doc("/v/case_1/declaration_1.pdf", doc)], schemas.PARSED)
    (bad,) = cases.unreadable_amounts(df).collect()
    assert bad.bad_amounts == ["1,5"]


def test_inventory(spark):
    files = ["/r/case_1/invoice_1.pdf", "/r/case_1/invoice_2.PDF", "/r/case_1/declaration_1.pdf",
             "/r/case_2/invoice_1.pdf", "/r/case_2/Declaration_1.pdf", "/r/case_3/readme.txt",
             "/r/notes/invoice_1.pdf", "/r/case_2/declaration_1.txt"]
    df = spark.createDataFrame([(f,) for f in files], "path string")
    inventory = cases.case_inventory(df)
    assert {r.id for r in inventory.collect()} == {"case_1", "case_2", "case_3"}
    (done,) = cases.complete_cases(inventory).collect()
    assert (done.id, done.invoice_path) == ("case_1", "/r/case_1/invoice_2.PDF")
    assert {r.id for r in cases.rejected_cases(inventory).collect()} == {"case_2", "case_3"}


SNAP = "id string, paths string, processed bigint, volume_path string"


def test_merges(spark):
    target = spark.createDataFrame([("a", "p1", 1, "v1"), ("z", "p0", 1, "v0")], SNAP)
    source = spark.createDataFrame([("a", "p2", 2, "v2"), ("b", "p3", 2, "v3")], SNAP)

    def rows(df):
        return sorted(map(tuple, df.collect()))

    assert rows(merge.upsert(target, source, "id")) == [
        ("a", "p1", 2, "v2"), ("b", "p3", 2, "v3"), ("z", "p0", 1, "v0"),
    ]
    assert rows(merge.insert_only(target, source, "id")) == [
        ("a", "p1", 1, "v1"), ("b", "p3", 2, "v3"), ("z", "p0", 1, "v0"),
    ]
    assert rows(merge.update_only(target, source, ["id"], ["paths"])) == [
        ("a", "p2", 1, "v1"), ("z", "p0", 1, "v0"),
    ]
    partial = source.select("id", "processed")
    assert ("b", None, 2, None) in rows(merge.upsert(target, partial, "id"))
    with pytest.raises(Exception, match="more than one source row"):
        merge.upsert(target, source.unionByName(source), "id").collect()


def test_changed_rows(spark):
    now = spark.createDataFrame([("a", "x"), ("b", "y2"), ("c", "z")], "id string, text string")
    old = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, text string").withColumn(
        "text_hash", merge.text_hash(F.col("text"))
    )
    assert sorted(r.id for r in merge.changed_rows(now, old).collect()) == ["b", "c"]


def test_pending(spark):
    rows = [("a", "", 1, None, "", False), ("b", "", 2, None, "", False), ("c", "", None, None, "", False),
            ("d", "", 1, "done", "", False)]
    df = spark.createDataFrame(rows, schemas.PARSED)
    assert sorted(r.path for r in cases.pending_documents(df, 1).collect()) == ["a", "c"]
    assert [r.path for r in cases.translated_run(df, 1).collect()] == ["d"]


def test_merge_on_two_keys_moves_no_target_row(spark):
    schema = "path string, processed bigint, note string"
    target = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 1, "n")], schema)
    source = spark.createDataFrame([("a", 2, "z"), ("b", 1, "w"), (None, 1, "m")], schema)
    got = merge.update_only(target, source, ["path", "processed"], ["note"])
    assert sorted(map(tuple, got.collect()), key=str) == [("a", 1, "x"), ("a", 2, "z"), (None, 1, "n")]
    both = merge.upsert(target, source, ["path", "processed"], ["note"])
    assert len(both.collect()) == 5
    final = both._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


def test_unreadable_documents(spark):
    good = '{"document":{"elements":[{"id":"1","type":"text","content":"A"}]}}'
    mixed = good.replace("[{", '["loose",{')
    rows = [("p1", "", 1, good, "en", False), ("p2", "", 1, mixed, "en", False),
            ("p3", "", 1, good[:-4], "en", False), ("p4", "", 1, None, "en", False)]
    df = spark.createDataFrame(rows, schemas.PARSED)
    assert sorted(map(tuple, cases.unreadable_documents(df).collect())) == [("p2", 1), ("p3", None)]
    assert sorted(r.document_path for r in cases.document_chunks(df).collect()) == ["p1", "p2"]


def test_batch_takes_up_waiting_cases(spark, tmp_path):
    root = str(tmp_path / "batch")
    document = '{"document":{"elements":[{"id":"1","type":"text","content":"A"}]}}'
    paths = [f"/cases/case_{k}/{r}_{k}.pdf" for k in (1, 2) for r in ("invoice", "declaration")]
    late = paths[-1]
    rows = [(p, document, 2 if p == late else 1, document, "en", False) for p in paths]
    parsed = spark.createDataFrame(rows, schemas.PARSED)
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    for _ in range(2):
        first = batch.run_batch(files.where(F.col("path") != late), parsed.where("processed = 1"), root, 1)
        assert {r.case_id for r in first.collect()} == {"case_1"} and first.count() == 2
    second = batch.run_batch(files.where(F.col("path") == late), parsed, root, 2)
    assert {r.case_id for r in second.collect()} == {"case_2"} and second.count() == 2
    assert "PartitionFilters: [isnotnull(processed" in second._jdf.queryExecution().executedPlan().toString()
    assert spark.read.parquet(f"{root}/index/log").count() == 4
    assert spark.read.parquet(f"{root}/waiting").where("processed = 2").count() == 0


def test_batch_reads_documents_once(spark, tmp_path):
    """One pass over the parsed documents gives their elements and what cannot be read of them."""
    good = '{"document":{"elements":[{"id":"1","type":"text","content":"A"}]}}'
    rows = [(f"/cases/case_{k}/invoice_{k}.pdf", good if k % 3 else good.replace("[{", '["loose",{')) for k in range(30)]
    rows = [(p, "", 1, t if k != 7 else t[:-4], "en", False) for k, (p, t) in enumerate(rows)]
    read = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            read.add(len(frame))
            yield frame

    parsed = spark.createDataFrame(rows, schemas.PARSED).mapInPandas(counted, schemas.PARSED)
    ready = spark.createDataFrame([(f"case_{k}",) for k in range(30)], "id string")
    documents = batch.take_up_documents(parsed, ready, str(tmp_path), 1)
    assert read.value == len(rows) and documents.count() == 30
    listed = {(r.path, r.bad_elements) for r in spark.read.parquet(f"{tmp_path}/{batch.UNREADABLE}").collect()}
    assert listed == {(rows[k][0], None if k == 7 else 1) for k in range(30) if k == 7 or k % 3 == 0}
    none = spark.createDataFrame([], schemas.CASES)
    stored = cases.enriched_chunks(documents, none, cases.ELEMENTS)
    assert "from_json" not in stored._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(
        map(tuple, cases.enriched_chunks(parsed, none).collect()), key=str
    )


def test_a_run_takes_up_every_listed_path_once(spark, tmp_path):
    """Ready and waiting cases come from one pass over the listing; a path listed twice changes nothing."""
    names = ["case_1/invoice_1.pdf", "case_1/declaration_1.pdf", "case_2/invoice_2.pdf", "case_2/invoice_2.pdf"]
    seen = spark.sparkContext.accumulator(0)

    def met(name):
        seen.add(1)
        return f"/cases/{name}"

    listed = spark.createDataFrame([(n,) for n in names], "name string")
    files = listed.select(F.udf(met, "string").asNondeterministic()("name").alias("path"))
    ready, waiting = batch.take_up_files(files, str(tmp_path), 1)
    assert [r.id for r in ready.collect()] == ["case_1"]
    assert [(r.id, r.invoice_path) for r in waiting.collect()] == [("case_2", "/cases/case_2/invoice_2.pdf")]
    assert seen.value == len(names)
