"""The registered queries: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

import time

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright import schemas
from casewright.functions import elements as el
from casewright.functions import embedding, fields, html, language, numeric, paths, text
from casewright.operators import (
    batch,
    cases,
    context,
    evaluation,
    index_store,
    language_model,
    logs,
    merge,
    ranking,
    rules,
    search,
    sessions,
    similarity_join,
    vector_index,
)
from casewright.plans import cases as fixture
from casewright.plans.cases import table
from casewright.plans.settings import ASKED_EVERY, CASE_FOLDERS, EMBED_DIMS, LANGUAGE_SAMPLE, LSH_BITS, LSH_TABLES
from casewright.session import shared_folder
from casewright.sources import files, tables
from casewright.streaming import case_stream, jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _r(c: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# --- sources and sinks -------------------------------------------------------


def _written_files(spark: SparkSession, d: str) -> tuple[str, str, str]:
    """All orders as lines of case files, a folder per group of customers, written in three goes.

    Returns the root and a time after the first and after the second.
    """
    root = shared_folder(spark, "files")
    lines = table(spark, d, "orders").select(
        F.concat(F.lit("order "), F.col("o_orderkey"), F.lit(" of "), F.col("o_custkey")).alias("value"),
        (F.col("o_orderkey") % len(_GOES)).alias("part"),
        (F.col("o_custkey") % CASE_FOLDERS).alias("case_"),
    )
    times = []
    for part, name in enumerate(_GOES):
        some = lines.where(F.col("part") == part).select("value", "case_")
        some.repartition("case_").write.partitionBy("case_").text(f"{root}/{name}")
        newest = files.list_files(spark, f"{root}/{name}", "*.txt").agg(F.max("modificationTime").alias("t"))
        # The next full second is after this go, and before the next one.
        after = F.date_format(F.col("t") + F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd'T'HH:mm:ss")
        times.append(newest.select(after).first()[0] or "1970-01-01T00:00:00")
        if part + 1 < len(_GOES):
            time.sleep(1.1)
    return root, times[0], times[1]


_GOES = ("early", "middle", "late")


def _case_of(path: str) -> Column:
    return F.concat(F.lit("case_"), F.regexp_extract(path, "case_=([0-9]+)", 1))


@query
def scan_binary(spark, d):
    """Every line of every written file."""
    root, *_ = _written_files(spark, d)
    content = F.decode("content", "UTF-8")
    return (
        files.read_binary(spark, root, "*.txt")
        .select(_case_of("path").alias("case"), F.explode(F.split(content, "\n")).alias("line"))
        .where("line <> ''")
    )


@query
def scan_incremental(spark, d):
    """The case files of the second go alone, by the times around it."""
    root, since, until = _written_files(spark, d)
    return files.list_case_files(spark, root, since, until, "*.txt").select(
        _case_of("path").alias("case"), F.col("length").alias("bytes")
    )


@query
def eval_questions(spark, d):
    """Question lines written from the test items and read back."""
    path = shared_folder(spark, "questions")
    table(spark, d, "benchmark").select(F.concat(F.lit("  "), "text", F.lit("\n \n"))).write.text(path)
    return files.read_questions(spark, path)


@query
def case_inventory(spark, d):
    return cases.case_inventory(fixture.case_files(spark, d))


@query
def complete_cases(spark, d):
    return cases.complete_cases(cases.case_inventory(fixture.case_files(spark, d)))


@query
def completeness(spark, d):
    return cases.completeness(cases.case_inventory(fixture.case_files(spark, d)))


@query
def ensure_columns(spark, d):
    wanted = {"O_ORDERSTATUS": "string", "processed": "bigint", "note": "string"}
    return tables.ensure_columns(table(spark, d, "orders"), wanted).select(
        "o_orderkey", "o_orderstatus", "processed", "note"
    )


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        fixture.run_stamp(F.col("o_orderdate")).alias("processed")
    )


@query
def latest_run(spark, d):
    return tables.latest_run(_runs(spark, d))


@query
def watermark_start(spark, d):
    start = tables.watermark_start(_runs(spark, d))
    return start.select(F.date_format("range_start", "yyyy-MM-dd HH:mm:ss").alias("range_start"))


@query
def sink_append_evolve(spark, d):
    """Two appends, the second with one more column, read back as one table."""
    path = shared_folder(spark, "append")
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.year("o_orderdate").cast("long").alias("processed"),
        "o_orderpriority",
    )
    tables.append_evolving(orders.where(F.col("processed") < 1998).drop("o_orderpriority"), path)
    tables.append_evolving(orders.where(F.col("processed") >= 1998), path)
    return tables.read_evolving(spark, path).select(
        "o_orderkey", "o_orderstatus", F.col("processed").cast("long"), "o_orderpriority"
    )


@query
def sink_overwrite_runs(spark, d):
    """Writing a run again replaces it and leaves the other runs alone."""
    path = shared_folder(spark, "runs")
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus", F.year("o_orderdate").cast("long").alias("processed")
    )
    tables.overwrite_runs(orders, path)
    again = orders.where(F.col("processed") == 1997).withColumn("o_orderstatus", F.lit("X"))
    tables.overwrite_runs(again, path)
    return spark.read.parquet(path).select(
        "o_orderkey", "o_orderstatus", F.col("processed").cast("long").alias("processed")
    )


@query
def sink_ignore(spark, d):
    """The second write finds the table and does nothing."""
    path = shared_folder(spark, "ignore")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    tables.create_if_absent(orders, path)
    tables.create_if_absent(orders.withColumn("o_orderstatus", F.lit("X")), path)
    return spark.read.parquet(path)


def _messages(spark: SparkSession, d: str) -> DataFrame:
    """Session messages; two in a row share a time, as saved in one transaction."""
    return table(spark, d, "conversations").select(
        F.col("turn").alias("id"),
        F.col("conv_id").cast("string").alias("session_id"),
        sessions.message_json(F.col("role"), F.col("text")).alias("message_data"),
        ((F.col("turn") - F.col("turn") % 2) * 30_000).alias("created_at_ms"),
    )


@query
def session_append(spark, d):
    path = shared_folder(spark, "sessions")
    rows = _messages(spark, d).select(
        "id",
        "session_id",
        "message_data",
        F.timestamp_millis("created_at_ms").alias("created_at"),
    )
    sessions.append_messages(rows.where(F.col("id") < 3), path)
    sessions.append_messages(rows.where(F.col("id") >= 3), path)
    return spark.read.parquet(path).select("id", "session_id", "message_data")


# --- filters and projections ------------------------------------------------


@query
def run_slice(spark, d):
    newest = tables.latest_run(fixture.case_table(spark, d)).scalar()
    return tables.run_slice(fixture.parsed_documents(spark, d), newest).select(
        "path", "source_language", "processed"
    )


@query
def pending_docs(spark, d):
    """Untranslated documents of the newest run, and French ones without a run."""
    newest = tables.latest_run(fixture.case_table(spark, d)).scalar()
    lang = F.col("source_language")
    parsed = (
        fixture.parsed_documents(spark, d)
        .withColumn("processed", F.when(lang != "fr", F.col("processed")))
        .withColumn("parsed_content_translated", F.when(lang == "en", F.col("parsed_content")))
    )
    return cases.pending_documents(parsed, newest).select("path", "source_language")


def _traces(spark: SparkSession, d: str) -> DataFrame:
    return logs.traces_from_events(table(spark, d, "events"))


@query
def project_scalars(spark, d):
    return logs.scalar_columns(_traces(spark, d))


@query
def trace_search(spark, d):
    found = logs.search_traces(
        _traces(spark, d),
        tags={"kind": "click"},
        metadata={"session": "user-7"},
        status="OK",
        since_ms=1_704_500_000_000,
    )
    return logs.scalar_columns(found).orderBy("timestamp_ms", "trace_id")


@query
def latest_traces(spark, d):
    return logs.latest(logs.scalar_columns(_traces(spark, d)), 20)


@query
def trace_stats(spark, d):
    return logs.duration_stats(_traces(spark, d)).select(
        "n", _r("avg_ms").alias("avg_ms"), "min_ms", "max_ms", "spans"
    )


@query
def status_counts(spark, d):
    return logs.status_counts(_traces(spark, d))


@query
def final_messages(spark, d):
    """Finished assistant messages out of an event log."""
    role = F.col("role")
    events = table(spark, d, "conversations").select(
        "conv_id",
        "turn",
        F.when(role == "system", "response.created")
        .otherwise("response.output_item.done")
        .alias("type"),
        F.struct(
            F.when(role == "assistant", "message").otherwise("function_call").alias("type"),
            F.col("text").alias("content"),
        ).alias("item"),
    )
    return sessions.final_messages(events)


# --- documents, fields, chunks ----------------------------------------------


@query
def parse_elements(spark, d):
    pages = table(spark, d, "pages").select("page_id", "html")
    return jobs.explode_page_elements(tables.spread(pages, "page_id"))


@query
def path_ids(spark, d):
    path = F.col("path")
    return fixture.case_files(spark, d).select(
        "path",
        paths.case_id(path).alias("case_id"),
        paths.document_id(path).alias("document_id"),
        paths.role(path).alias("role"),
    )


def _elements(spark: SparkSession, d: str) -> DataFrame:
    return fixture.parsed_documents(spark, d).select(
        "path",
        "source_language",
        el.document_elements(F.col("parsed_content_translated")).alias("elements"),
    )


@query
def html_table_cells(spark, d):
    """The last table of every document, one row per table row."""
    cells = html.table_cells(el.last_table(F.col("elements")))
    return (
        _elements(spark, d)
        .select("path", F.posexplode(cells))
        .select("path", F.col("pos").alias("row_no"), F.array_join("col", "|").alias("cells"))
    )


@query
def invoice_fields(spark, d):
    f = fields.invoice_fields(F.col("elements"))
    return (
        _elements(spark, d)
        .where(paths.role(F.col("path")) == "invoice")
        .select("path", f.alias("f"))
        .select("path", "f.amount", "f.currency")
    )


@query
def declaration_fields(spark, d):
    f = fields.declaration_fields(F.col("elements"))
    return (
        _elements(spark, d)
        .where(paths.role(F.col("path")) == "declaration")
        .select("path", f.alias("f"))
        .select("path", "f.*")
        .withColumn("bad_amounts", F.size("bad_amounts"))
    )


@query
def royalty_pct(spark, d):
    return _elements(spark, d).select(
        "path", fields.royalty_percentage(F.col("elements")).alias("royalty_percentage")
    )


@query
def structured_metadata(spark, d):
    return cases.document_fields(fixture.parsed_documents(spark, d)).drop("bad_amounts")


@query
def case_rollup(spark, d):
    return cases.case_rollup(fixture.parsed_documents(spark, d))


@query
def extract_chunks(spark, d):
    return cases.document_chunks(fixture.parsed_documents(spark, d))


def _damaged_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents of which some are cut off and some have a bare string among their elements."""
    key = F.regexp_extract("path", "case_([0-9]+)", 1).cast("long")
    text = F.col("parsed_content_translated")
    damaged = F.when(key % 13 == 0, text.substr(F.lit(1), F.length(text) - 5)).when(
        key % 13 == 1, F.replace(text, F.lit('"elements":['), F.lit('"elements":["loose",'))
    )
    return fixture.parsed_documents(spark, d).withColumn(
        "parsed_content_translated", F.coalesce(damaged, text)
    )


@query
def unreadable_documents(spark, d):
    return cases.unreadable_documents(_damaged_documents(spark, d))


@query
def damaged_chunks(spark, d):
    """Chunks per document where some documents and elements cannot be read."""
    chunks = cases.document_chunks(_damaged_documents(spark, d))
    return chunks.groupBy("document_path").agg(F.count(F.lit(1)).alias("chunks"))


@query
def chunks_enriched(spark, d):
    return cases.enriched_chunks(
        fixture.parsed_documents(spark, d), fixture.case_table(spark, d)
    )


def _stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The same rows, made once however many runs read them."""
    folder = shared_folder(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _run_batches(spark: SparkSession, d: str, root: str, again: bool) -> None:
    """Two runs; in the first, the declarations of every sixth case are still missing."""
    key = F.regexp_extract("path", "case_([0-9]+)", 1).try_cast("long")
    late = F.coalesce((key % 6 == 1) & F.col("path").contains("declaration"), F.lit(False))
    listed = _stored(fixture.case_files(spark, d), "listing")
    parsed = _stored(fixture.parsed_documents(spark, d), "parsed").withColumn(
        "processed", F.when(late, 2).otherwise(1).cast("long")
    )
    first = listed.where(~late)
    batch.run_batch(first, parsed, root, 1)
    if again:
        batch.run_batch(first, parsed, root, 1)
    batch.run_batch(listed.where(late), parsed, root, 2)


def _batch_runs(spark: SparkSession, d: str, again: bool) -> DataFrame:
    root = shared_folder(spark, "batch")
    _run_batches(spark, d, root, again)
    return spark.read.parquet(f"{root}/{batch.CHUNKS}")


_BATCH_COLUMNS = ("id", "case_id", "text", "invoice_total", "declaration_total", "metadata")


@query
def pipeline_run(spark, d):
    """The batch pipeline over two runs; the late files complete waiting cases."""
    return _batch_runs(spark, d, again=False).select(*_BATCH_COLUMNS, F.col("processed").cast("long"))


@query
def pipeline_rerun(spark, d):
    """The same with the first run repeated: nothing is stored twice."""
    return _batch_runs(spark, d, again=True).select(*_BATCH_COLUMNS, F.col("processed").cast("long"))


@query
def pipeline_search(spark, d):
    """Keyword search for some suppliers in the chunks that the two batch runs stored and indexed."""
    root = shared_folder(spark, "batch")
    _run_batches(spark, d, root, again=False)
    asked = table(spark, d, "supplier").where("s_suppkey % 25 = 1").select(
        F.col("s_suppkey").alias("query_id"), F.concat(F.lit("goods supplied by "), "s_name").alias("text")
    )
    snapshot = index_store.compact(spark, f"{root}/{batch.INDEX}")
    return _rounded(index_store.keyword_search(spark, snapshot, asked, 5))


@query
def translation_payload(spark, d):
    return _elements(spark, d).select(
        "path", el.translation_payload(F.col("elements")).alias("payload")
    )


def _translated_items(header: Column) -> Column:
    """Items a translator might send: one good, one unreadable, one beyond the end."""

    def item(idx: str, content: Column) -> Column:
        return F.struct(F.lit(idx).alias("idx"), content.alias("content"))

    return F.array(
        item("0", F.lit("overwritten")),
        item("x", F.lit("unreadable")),
        item("99", F.lit("beyond")),
        item("0", F.concat(F.lit(" EN: "), header, F.lit(" "))),
    )


@query
def apply_translations(spark, d):
    rows = _elements(spark, d).withColumn(
        "items",
        F.when(
            F.col("source_language") != "en",
            _translated_items(F.element_at("elements", 1)["content"]),
        ).otherwise(F.array().cast(el.ITEM_TYPE)),
    )
    merged = rows.select(
        "path", el.apply_translations(F.col("elements"), F.col("items")).alias("e")
    )
    return merged.select(
        "path",
        F.size("e").alias("elements"),
        F.element_at("e", 1)["content"].alias("first_content"),
        F.array_join(F.col("e.type"), "|").alias("types"),
    )


@query
def translation_outcome(spark, d):
    """Replies of several kinds, one per document, and what becomes of them."""
    header = F.element_at("elements", 1)["content"]
    lang = F.col("source_language")
    reply = (
        F.when(
            lang == "es",
            F.concat(
                F.lit("Here it is:\n```json\n"),
                F.to_json(
                    F.struct(
                        F.upper(lang).alias("source_language"),
                        _translated_items(header).alias("items"),
                    )
                ),
                F.lit("\n```"),
            ),
        )
        .when(lang == "fr", F.lit('{"source_language": " FR ", "items": [{"idx": "?"}]}'))
        .when(lang == "de", F.lit("I cannot do that."))
        .otherwise(F.lit('{"source_language":"en","items":[{"idx":0,"content":"x"}]}'))
    )
    outcome = el.translation_outcome(F.col("parsed_content"), reply)
    rows = fixture.parsed_documents(spark, d).withColumn(
        "elements", el.document_elements(F.col("parsed_content"))
    )
    return rows.select("path", outcome.alias("o")).select(
        "path",
        F.col("o.source_language").alias("source_language"),
        F.col("o.applied").alias("applied"),
        F.element_at(el.document_elements(F.col("o.content")), 1)["content"].alias("first_content"),
    )


@query
def recover_json(spark, d):
    """Objects recovered from replies wrapped in different ways."""
    body = F.to_json(F.struct(F.col("turn"), F.col("role")))
    reply = (
        F.when(F.col("turn") % 4 == 0, F.concat(F.lit(" \n"), body))
        .when(F.col("turn") % 4 == 1, F.concat(F.lit("Sure:\n```JSON\n"), body, F.lit("\n```\nDone.")))
        .when(F.col("turn") % 4 == 2, F.concat(F.lit("The answer is ["), body, F.lit("], I think.")))
        .otherwise(F.concat(F.lit("no object: "), F.col("role")))
    )
    found = el.recover_json_object(reply)
    return (
        table(spark, d, "conversations")
        .select("conv_id", "turn", found.alias("o"))
        .select(
            "conv_id",
            "turn",
            F.get_json_object("o", "$.role").alias("found_role"),
            F.get_json_object("o", "$.turn").cast("long").alias("found_turn"),
        )
    )


# --- rules -------------------------------------------------------------------


@query
def anomalies_all(spark, d):
    return rules.detect_anomalies(cases.case_rollup(fixture.parsed_documents(spark, d)))


@query
def anomalies_one_rule(spark, d):
    rollup = cases.case_rollup(fixture.parsed_documents(spark, d))
    return rules.detect_anomalies(rollup, "DECLARATION_TOTAL_MISMATCH")


@query
def anomalies_sql_fn_one(spark, d):
    """The SQL function with its argument."""
    cases.case_rollup(fixture.parsed_documents(spark, d)).createOrReplaceTempView("case_fields_one")
    rules.register_detect_anomalies(spark, "case_fields_one", "detect_anomalies")
    return spark.sql("SELECT * FROM detect_anomalies('ROYALTY_MISMATCH')")


@query
def anomalies_sql_fn(spark, d):
    """The SQL table function over the chunk table, default argument."""
    chunks_enriched(spark, d).createOrReplaceTempView("audit_chunks")
    rules.register_detect_anomalies(spark, "audit_chunks")
    return spark.sql("SELECT * FROM detect_anomalies()")


# --- merges ------------------------------------------------------------------


def _merge_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A snapshot of the customers in credit, and changes for some nations."""
    customers = table(spark, d, "customer")
    id_ = F.concat(F.lit("case_"), F.col("c_custkey"))
    target = customers.where(F.col("c_acctbal") >= 0).select(
        id_.alias("id"),
        F.concat(F.lit("/old/"), "c_name").alias("invoice_path"),
        F.lit(1).cast("long").alias("processed"),
        F.col("c_mktsegment").alias("volume_path"),
    )
    source = customers.where(F.col("c_nationkey") < 13).select(
        id_.alias("id"),
        F.concat(F.lit("/new/"), "c_name").alias("invoice_path"),
        F.lit(2).cast("long").alias("processed"),
        F.lit("v2").alias("volume_path"),
    )
    return target, source


@query
def merge_upsert(spark, d):
    return merge.upsert(*_merge_sides(spark, d), "id")


@query
def merge_insert_only(spark, d):
    return merge.insert_only(*_merge_sides(spark, d), "id")


@query
def merge_update_only(spark, d):
    return merge.update_only(
        *_merge_sides(spark, d), "id", ("invoice_path", "processed", "volume_path")
    )


@query
def index_delta(spark, d):
    """Documents to embed: the index has the English ones and stale French ones."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    indexed = docs.where(F.col("lang").isin("en", "fr")).select(
        "id",
        merge.text_hash(
            F.when(F.col("lang") == "fr", F.concat("text", F.lit("?"))).otherwise(F.col("text"))
        ).alias("text_hash"),
    )
    return merge.changed_rows(docs, indexed).select("id", "lang")


# --- text --------------------------------------------------------------------


def _documents(spark: SparkSession, d: str, *extra: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", *extra)
    return tables.spread(docs, "id")


@query
def clean_text(spark, d):
    return _documents(spark, d).select("id", text.clean_text(F.col("text")).alias("cleaned"))


@query
def excerpt(spark, d):
    return _documents(spark, d).select(
        "id",
        text.excerpt(F.col("text")).alias("excerpt"),
        text.preview(F.col("text")).alias("preview"),
    )


@query
def chunk_stats(spark, d):
    n = F.length("text")
    return _documents(spark, d).agg(
        F.count(F.lit(1)).alias("n"),
        _r(F.avg(n)).alias("avg_length"),
        F.min(n).alias("min_length"),
        F.max(n).alias("max_length"),
    )


@query
def chunk_fixed(spark, d):
    return _documents(spark, d).select("id", F.inline(text.fixed_chunks(F.col("text"))))


@query
def chunk_sentence(spark, d):
    return (
        _documents(spark, d)
        .select("id", F.posexplode(text.sentence_chunks(F.col("text"))))
        .select("id", F.col("pos").alias("chunk_no"), F.col("col").alias("text"))
    )


@query
def chunk_paragraph(spark, d):
    return (
        _documents(spark, d)
        .select("id", F.posexplode(text.paragraph_chunks(F.col("text"), "\n", 128)))
        .select("id", F.col("pos").alias("chunk_no"), F.col("col").alias("text"))
    )


@query
def detect_language(spark, d):
    return _documents(spark, d).select("id", language.detect_language(F.col("text")).alias("detected"))


def _language_sample(spark: SparkSession, d: str) -> DataFrame:
    return language_model.sampled(_documents(spark, d, "lang"), LANGUAGE_SAMPLE)


@query
def language_grams(spark, d):
    """How many sampled texts of each language have each character 3-gram."""
    return language_model.gram_counts(_language_sample(spark, d))


@query
def detect_language_grams(spark, d):
    """The language of every document by a model of its sample's 3-grams."""
    model = language_model.fit(_language_sample(spark, d))
    found = language_model.detect(_documents(spark, d), model)
    return found.select("id", F.col("lang").alias("detected"), _r("score", 3).alias("score"))


@query
def dedup_exact(spark, d):
    return context.drop_exact_duplicates(_documents(spark, d))


# --- arithmetic and cost -----------------------------------------------------


@query
def arith_functions(spark, d):
    numeric.register_arithmetic(spark)
    return table(spark, d, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "add_numbers(l_extendedprice, l_quantity) AS added",
        "subtract_numbers(l_extendedprice, l_quantity) AS subtracted",
        "multiply_numbers(l_quantity, l_discount) AS multiplied",
        "divide_numbers(l_quantity, l_discount) AS divided",
    )


@query
def calculator(spark, d):
    operation = F.element_at(
        F.array(*map(F.lit, ("add", "subtract", "multiply", "divide"))),
        (F.col("l_linenumber") % 4 + 1).cast("int"),
    )
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        numeric.calculator(operation, F.col("l_quantity"), F.col("l_discount")).alias("result"),
    )


def _usage(spark: SparkSession, d: str, models: int) -> DataFrame:
    return table(spark, d, "events").select(
        (F.col("event_id") % models).alias("m"),
        F.round(F.col("value") * 100).cast("long").alias("tokens_in"),
        F.get_json_object("props", "$.k").cast("long").alias("tokens_out"),
        F.date_trunc("hour", "ts").alias("hour"),
    )


def _model_name(prices: tuple, m: Column) -> Column:
    return F.element_at(F.array(*[F.lit(p[0]) for p in prices]), (m + 1).cast("int"))


@query
def usage_cost(spark, d):
    usage = _usage(spark, d, len(logs.TOKEN_PRICES)).withColumn(
        "model", _model_name(logs.TOKEN_PRICES, F.col("m"))
    )
    return logs.usage_cost(usage, logs.token_prices(spark)).withColumn("cost", _r("cost"))


@query
def provisioned_cost(spark, d):
    """Reserved capacity for the hours in which a model was used."""
    hours = (
        _usage(spark, d, len(logs.HOURLY_PRICES))
        .select(_model_name(logs.HOURLY_PRICES, F.col("m")).alias("model"), "hour")
        .distinct()
        .groupBy("model")
        .agg(F.count(F.lit(1)).alias("hours"))
    )
    cost = numeric.reserved_cost(F.lit(1), F.col("hours"), F.col("entry_rate"))
    return (
        hours.join(logs.hourly_prices(spark), "model")
        .select("model", "hours", cost.alias("c"))
        .select(
            "model",
            "hours",
            _r("c.total_cost").alias("total_cost"),
            F.col("c.total_tokens").alias("total_tokens"),
            _r("c.cost_per_million").alias("cost_per_million"),
        )
    )


@query
def cost_difference(spark, d):
    """Paying per token against reserved capacity for the hours used."""
    paid = usage_cost(spark, d).select("model", "cost")
    reserved = provisioned_cost(spark, d).select("model", "total_cost")
    difference = numeric.cost_difference(F.col("cost"), F.col("total_cost"))
    return paid.join(reserved, "model").select("model", _r(difference).alias("difference"))


# --- vector search -----------------------------------------------------------


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label"
    )


def _knn(spark: SparkSession, d: str, k: int = 10, **options) -> DataFrame:
    vectors = _vectors(spark, d)
    return search.vector_search(vectors, search.label_centroids(vectors), k, **options)


def _rounded(hits: DataFrame) -> DataFrame:
    return hits.select("query_id", "id", "rank", _r("score").alias("score"))


@query
def knn_topk(spark, d):
    return _rounded(_knn(spark, d))


@query
def knn_dot(spark, d):
    return _rounded(_knn(spark, d, metric="dot"))


@query
def knn_l2(spark, d):
    return _rounded(_knn(spark, d, metric="l2"))


@query
def knn_filtered(spark, d):
    return _rounded(_knn(spark, d, filters={"label": 3}))


@query
def knn_range_filtered(spark, d):
    return _rounded(_knn(spark, d, filters="label >= 5"))


def _asked(vectors: DataFrame) -> DataFrame:
    """The rows that search for their neighbours."""
    return vectors.where(F.col("id") % ASKED_EVERY == 0).withColumnRenamed("id", "query_id")


@query
def ann_lsh(spark, d):
    """Approximate search through hyperplane buckets."""
    codes = embedding.plane_codes(F.col("vector"), 64, LSH_TABLES, LSH_BITS)
    vectors = _vectors(spark, d).withColumn("codes", codes)
    return _rounded(search.approximate_search(vectors, _asked(vectors), 10))


@query
def ann_candidates(spark, d):
    """How many rows of each query's buckets approximate search scores."""
    codes = embedding.plane_codes(F.col("vector"), 64, LSH_TABLES, LSH_BITS)
    vectors = _vectors(spark, d).withColumn("codes", codes)
    return search.candidate_counts(vectors, _asked(vectors))


def _cells(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, vector_index.Model]:
    """Stored index of all vectors, the rows that ask, and the fitted model."""
    vectors = _vectors(spark, d)
    model = vector_index.fit(vectors)
    return vector_index.build(vectors, model, shared_folder(spark, "cells")), _asked(vectors), model


@query
def ann_cells(spark, d):
    """Approximate search through the inverted file, for every row whose id 20 divides."""
    index, asked, model = _cells(spark, d)
    return _rounded(vector_index.cell_search(index, asked, model, 10))


@query
def ann_cells_met(spark, d):
    """How many cells each query looks into, and how many rows it meets there."""
    return vector_index.rows_met(*_cells(spark, d))


@query
def retrieval_metrics(spark, d):
    vectors = _vectors(spark, d)
    hits = _knn(spark, d)
    n = vectors.select("label").distinct().count()
    labelled = search.attach(hits, vectors.select("id", "label"), n, 10).select(
        "query_id", "rank", (F.col("label") == F.col("query_id")).alias("relevant")
    )
    totals = vectors.groupBy(F.col("label").alias("query_id")).agg(
        F.count(F.lit(1)).alias("total_relevant")
    )
    m = evaluation.retrieval_metrics(labelled, totals, 10)
    return m.select("query_id", *[_r(c).alias(c) for c in ("precision", "recall", "mrr", "ndcg")])


# --- keyword and hybrid search ----------------------------------------------


def _questions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _stored_columns(rows: DataFrame) -> DataFrame:
    return index_store.text_columns(rows, embedding.hash_embedding(F.col("text"), EMBED_DIMS), "lang")


_indexes: dict[tuple[str, str], index_store.Snapshot] = {}


def _index(spark: SparkSession, d: str) -> index_store.Snapshot:
    """The stored index of all documents, synchronised and compacted once per session and folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _indexes:
        root = shared_folder(spark, "index")
        docs = jobs.read_table_stream(spark, d, "documents", schemas.DOCUMENTS).select(
            F.col("doc_id").alias("id"), "text", "lang"
        )
        index_store.sync(docs, root, f"{root}-checkpoint", _stored_columns)
        _indexes[key] = index_store.compact(spark, root)
    return _indexes[key]


def _embedded(spark: SparkSession, d: str) -> DataFrame:
    return _questions(spark, d).withColumn("vector", embedding.hash_embedding(F.col("text"), EMBED_DIMS))


def _keyword(spark: SparkSession, d: str, k: int) -> DataFrame:
    return index_store.keyword_search(spark, _index(spark, d), _questions(spark, d), k)


def _semantic(spark: SparkSession, d: str, k: int) -> DataFrame:
    stored = index_store.live_rows(spark, _index(spark, d)).select("id", "vector")
    return search.vector_search(stored, _embedded(spark, d), k)


POOL = 20


def _hybrid(spark: SparkSession, d: str, k: int) -> DataFrame:
    return index_store.hybrid_search(spark, _index(spark, d), _embedded(spark, d), k, POOL)


@query
def embed_hash(spark, d):
    v = embedding.hash_embedding(F.col("text"), EMBED_DIMS)
    return (
        _documents(spark, d)
        .select("id", v.alias("v"))
        .select(
            "id",
            F.size(F.filter("v", lambda x: x > 0)).alias("filled"),
            _r(F.array_max("v")).alias("greatest"),
        )
    )


@query
def embed_tfidf(spark, d):
    out = embedding.tfidf_embedding(_documents(spark, d))
    return out.select("id", F.size(F.filter("vector", lambda x: x != 0)).alias("filled"))


@query
def bm25_topk(spark, d):
    return _rounded(_keyword(spark, d, 10))


@query
def hybrid_rrf(spark, d):
    return _rounded(_hybrid(spark, d, 10))


@query
def hybrid_weighted(spark, d):
    fused = search.fuse_scores(
        [(_semantic(spark, d, POOL), 0.6), (_keyword(spark, d, POOL), 0.4)], 10
    )
    return _rounded(fused)


@query
def rerank_two_stage(spark, d):
    return _rounded(
        search.rerank(_keyword(spark, d, POOL), _documents(spark, d), _questions(spark, d), 5)
    )


def _strategies(spark: SparkSession, d: str, k: int = 3) -> DataFrame:
    semantic = _semantic(spark, d, POOL)
    pool = search.fuse_ranks([semantic, _keyword(spark, d, POOL)], POOL)
    return search.compare_strategies(
        {
            "semantic": semantic.where(F.col("rank") <= k),
            "hybrid": ranking.top_k(pool.drop("rank"), ["query_id"], [F.desc("score"), F.col("id")], k),
            "hybrid_rerank": search.rerank(pool, _documents(spark, d), _questions(spark, d), k),
        }
    )


@query
def strategy_compare(spark, d):
    return _strategies(spark, d)


@query
def strategy_overlap(spark, d):
    return search.strategy_overlap(_strategies(spark, d))


@query
def multi_query_fusion(spark, d):
    """Each line of a question is one phrasing of it."""
    lines = (
        _questions(spark, d)
        .select("query_id", F.posexplode(text.nonblank_lines(F.col("text"))))
        .select(
            (F.col("query_id") * 100_000 + F.col("pos")).alias("query_id"),
            F.col("col").alias("text"),
        )
    )
    hits = search.keyword_search(_documents(spark, d), lines, 10)
    by_question = hits.withColumn("query_id", F.floor(F.col("query_id") / 100_000).cast("long"))
    return search.best_rank_union(by_question, 5)


# --- context -----------------------------------------------------------------


def _passages(spark: SparkSession, d: str, k: int) -> DataFrame:
    """Keyword hits with the columns of their documents."""
    n = _questions(spark, d).count()
    return search.attach(_keyword(spark, d, k), _documents(spark, d, "lang", "source"), n, k)


@query
def context_order(spark, d):
    return context.order_for_attention(_knn(spark, d)).select("query_id", "id", "position")


@query
def context_by_role(spark, d):
    role = (
        F.when(F.col("lang") == "en", "invoice")
        .when(F.col("lang") == "fr", "declaration")
        .when(F.col("lang") == "de", "royalty")
    )
    hits = _passages(spark, d, 10).withColumn("role", role)
    return context.order_by_role(hits).select("query_id", "id", "position")


@query
def context_by_source(spark, d):
    return context.order_by_source(_passages(spark, d, 10), "source").select(
        "query_id", "id", "position"
    )


@query
def context_budget(spark, d):
    budget = context.available_tokens(2048, 200, 100, 1000)
    return context.within_budget(_passages(spark, d, 10), budget).select(
        "query_id", "id", "rank", "used_tokens"
    )


@query
def dedup_near(spark, d):
    return context.without_near_duplicates(_passages(spark, d, POOL), 0.5).select(
        "query_id", "id", "rank"
    )


@query
def near_join(spark, d):
    """Copies and near-duplicates of every document, by shingles of five words."""
    return similarity_join.near_duplicates(_documents(spark, d))


@query
def rag_context(spark, d):
    block = context.passage_block(F.col("rank"), F.col("id"), F.col("source"), F.col("text"))
    assembled = context.assemble(_passages(spark, d, 5), block)
    prompt = context.rag_prompt(F.col("text"), F.col("context"))
    return assembled.join(_questions(spark, d), "query_id").select(
        "query_id", "context", "sources", prompt.alias("prompt")
    )


def _hybrid_hits(spark: SparkSession, d: str, k: int, filters=None) -> DataFrame:
    """Hits of hybrid search with the columns of their documents."""
    vector = embedding.hash_embedding(F.col("text"), EMBED_DIMS)
    corpus = _documents(spark, d, "lang", "source").withColumn("vector", vector)
    asked = _questions(spark, d).withColumn("vector", vector)
    hits = search.hybrid_search(corpus, asked, k, POOL, filters)
    return search.attach(hits, _documents(spark, d, "lang", "source"), asked.count(), k)


@query
def rag_batch(spark, d):
    """Every question with numbered passages, a prompt and its list of sources."""
    block = context.numbered_block(F.col("rank"), F.col("text"))
    source = F.struct("id", "source")
    made = context.assemble(_hybrid_hits(spark, d, 5), block, "\n\n", source)
    return made.join(_questions(spark, d), "query_id").select(
        "query_id",
        F.to_json("sources").alias("sources"),
        context.document_prompt(F.col("text"), F.col("context")).alias("prompt"),
    )


@query
def rag_chat(spark, d):
    """The same as chat messages, from passages above a score."""
    block = context.cited_block(F.col("id"), F.col("source"), F.col("text"))
    hits = context.relevant(_hybrid_hits(spark, d, 5), 0.02)
    messages = context.chat_messages(F.col("text"), F.col("context"))
    return (
        context.assemble(hits, block, "\n\n")
        .join(_questions(spark, d), "query_id")
        .select("query_id", F.posexplode(messages))
        .select("query_id", "pos", "col.role", "col.content")
    )


@query
def search_records(spark, d):
    """JSON records of the hits in one language."""
    record = context.hit_record(F.col("source"), F.col("id"), F.col("lang"), F.col("text"))
    return _hybrid_hits(spark, d, 3, {"lang": "es"}).select("query_id", "rank", record.alias("record"))


@query
def extractive_summary(spark, d):
    return context.extractive_summary(_documents(spark, d)).withColumn("score", _r("score"))


@query
def diverse_summary(spark, d):
    """Two sentences of every document that say much and differ."""
    chosen = context.diverse_summary(_documents(spark, d))
    return chosen.select("id", "sentence_no", "sentence", _r("score").alias("score"))


@query
def result_rows(spark, d):
    """Search hits as column names plus values, read back as maps."""
    names = F.array(*map(F.lit, ("id", "rank", "score", "missing")))
    row = F.array(F.col("id").cast("string"), F.col("rank").cast("string"))
    packed = _keyword(spark, d, 10).select("query_id", search.result_rows(names, row).alias("m"))
    return packed.select(
        "query_id",
        F.size("m").alias("entries"),
        F.col("m")["id"].cast("long").alias("id"),
        F.col("m")["rank"].cast("int").alias("rank"),
    )


# --- sessions ----------------------------------------------------------------


@query
def session_history(spark, d):
    return sessions.session_history(_messages(spark, d)).select("session_id", "seq", "message_data")


@query
def last_message(spark, d):
    return sessions.last_message(table(spark, d, "conversations"))


@query
def conversation_prompt(spark, d):
    history = table(spark, d, "conversations")
    known = history.select("conv_id").distinct()
    inputs = known.unionByName(
        known.select((F.col("conv_id") + 1_000_000_000).alias("conv_id"))
    ).withColumn("text", F.concat(F.lit("Next for "), F.col("conv_id")))
    return sessions.conversation_prompt(history, "You audit customs cases.", inputs)


# --- scoring -----------------------------------------------------------------


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.score_answers(table(spark, d, "conversations"), "text")


SCORERS = (
    "word_count_check",
    "mentions_valuation_docs",
    "evidence_citations",
    "uses_detect_anomalies",
    "has_code_example",
    "response_length_score",
)


@query
def score_answers(spark, d):
    return _scored(spark, d).select("conv_id", "turn", *SCORERS)


@query
def eval_summary(spark, d):
    return evaluation.summarise_scores(_scored(spark, d), list(SCORERS)).withColumn(
        "value", _r("value")
    )


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """Each message against the one before it."""
    turns = table(spark, d, "conversations")
    before = turns.select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("reference")
    )
    return turns.join(before, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"),
        F.col("text").alias("candidate"),
        "reference",
    )


@query
def text_overlap_metrics(spark, d):
    return evaluation.text_overlap_metrics(_pairs(spark, d)).select(
        "pair_id", "exact_match", _r("token_f1").alias("token_f1"), _r("rouge1").alias("rouge1")
    )


@query
def bleu4(spark, d):
    return evaluation.bleu(_pairs(spark, d)).select("pair_id", _r("bleu").alias("bleu"))


@query
def bleu(spark, d):
    return evaluation.bleu(_pairs(spark, d), 2).select("pair_id", _r("bleu").alias("bleu"))


# --- streams -----------------------------------------------------------------


def _hourly(windows: DataFrame) -> DataFrame:
    return windows.select(
        F.date_format("start", "yyyy-MM-dd HH:mm").alias("hour"),
        "requests",
        "errors",
        "latency_sum",
        "latency_max",
    )


@query
def log_hourly(spark, d):
    events = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return _hourly(logs.windowed_activity(events))


@query
def stream_log_hourly(spark, d):
    path = shared_folder(spark, "hourly")
    events = jobs.read_table_stream(spark, d, "events", schemas.EVENTS).withColumn(
        "ts", F.col("ts").cast("timestamp")
    )
    jobs.monitor(events, path, f"{path}-checkpoint")
    return _hourly(jobs.newest_windows(spark, path))


@query
def stream_sessions(spark, d):
    """Three runs: later messages first, then all of them, then all again without a checkpoint."""
    path = shared_folder(spark, "stream-sessions")
    turns = jobs.read_table_stream(spark, d, "conversations", schemas.CONVERSATIONS)
    messages = turns.select(
        F.col("turn").alias("id"),
        F.col("conv_id").cast("string").alias("session_id"),
        sessions.message_json(F.col("role"), F.col("text")).alias("message_data"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("turn") * 3600).alias("created_at"),
    )
    jobs.append_sessions(messages.where(F.col("id") >= 2), path, f"{path}-late")
    jobs.append_sessions(messages, path, f"{path}-all")
    jobs.append_sessions(messages, path, f"{path}-again")
    return spark.read.parquet(path).select("session_id", "id", "message_data")


@query
def stream_elements(spark, d):
    path = shared_folder(spark, "stream-elements")
    pages = jobs.read_table_stream(spark, d, "pages", "page_id bigint, url string, html string")
    jobs.extract_pages(pages, path, f"{path}-checkpoint")
    return spark.read.parquet(path).select("page_id", "idx", "type", "content")


def _streamed_cases(spark: SparkSession, d: str) -> str:
    """Three runs: every sixth case gets its declaration in the second, every tenth its royalty in the third."""
    root, listing = shared_folder(spark, "stream-cases"), shared_folder(spark, "listing")
    key = F.regexp_extract("path", "case_([0-9]+)", 1).try_cast("long")
    late = F.when((key % 6 == 1) & F.col("path").contains("declaration"), 2).when(
        (key % 10 == 0) & F.col("path").contains("royalty"), 3
    )
    files = fixture.case_files(spark, d).withColumn("arrival", F.coalesce(late, F.lit(1)))
    arriving, documents = shared_folder(spark, "arriving"), shared_folder(spark, "parsed")
    files.write.partitionBy("arrival").parquet(arriving)
    fixture.parsed_documents(spark, d).write.parquet(documents)
    for number in (1, 2, 3):
        spark.read.parquet(f"{arriving}/arrival={number}").write.mode("append").parquet(listing)
        listed = jobs.read_stream(spark, listing, "path string")
        # Only documents whose files have arrived are parsed by then.
        seen = spark.read.parquet(arriving).where(F.col("arrival") <= number)
        seen = seen.select(F.regexp_replace("path", "PDF$", "pdf").alias("path"))
        case_stream.stream_cases(
            listed,
            lambda s, seen=seen: s.read.parquet(documents).join(seen, "path", "left_semi"),
            root,
            f"{root}-checkpoint",
        )
    return root


@query
def stream_cases(spark, d):
    """The chunk table of the streamed case pipeline after three runs with late files."""
    return case_stream.current_chunks(spark, _streamed_cases(spark, d)).select(*_BATCH_COLUMNS)


@query
def stream_waiting(spark, d):
    """Cases that still wait for a document after the three runs."""
    waiting = case_stream.waiting_cases(spark, _streamed_cases(spark, d))
    return waiting.select("id", F.col("invoice_path").isNotNull().alias("has_invoice"))


def _partly_stored(spark: SparkSession, d: str) -> index_store.Snapshot:
    """The index after two runs and compactions, the first over a part of the documents."""
    root = shared_folder(spark, "stream-index")
    docs = jobs.read_table_stream(spark, d, "documents", schemas.DOCUMENTS).select(
        F.col("doc_id").alias("id"), "text", "lang"
    )
    index_store.sync(docs.where(F.col("lang") != "en"), root, f"{root}-part", _stored_columns)
    index_store.compact(spark, root)
    index_store.sync(docs, root, f"{root}-all", _stored_columns)
    return index_store.compact(spark, root)


def _contents(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id",
        F.size(F.filter("vector", lambda x: x > 0)).alias("filled"),
        _r(F.array_max("vector")).alias("greatest"),
    )


@query
def stream_index_sync(spark, d):
    """The stored vectors after two runs, the first of them over a part of the documents."""
    return _contents(index_store.live_rows(spark, _partly_stored(spark, d)))


def _changed(spark: SparkSession, d: str) -> index_store.Snapshot:
    """The index after the source changed: some documents are gone, some changed, some new."""
    root = shared_folder(spark, "changed-index")
    before = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    old = before.where(F.col("lang") != "fr")
    more = F.when(F.col("id") % 3 == 0, F.concat("text", F.lit(" and once more"))).otherwise(F.col("text"))
    twice = old.where(F.col("id") % 10 == 0).withColumn("id", -1 - F.col("id"))
    after = old.withColumn("text", more).unionByName(twice)
    for number, source in enumerate((before, after)):
        folder = shared_folder(spark, "snapshot")
        source.write.parquet(folder)
        docs = jobs.read_stream(spark, folder, "id long, text string, lang string")
        index_store.sync(docs, root, f"{root}-{number}", _stored_columns)
        snapshot = index_store.compact(spark, root)
    live = index_store.live_rows(spark, snapshot)
    jobs.delete_missing(spark.read.parquet(folder), f"{root}/{index_store.LOG}", live)
    return index_store.compact(spark, root)


@query
def index_delete(spark, d):
    """What the index holds after insertions, changes and deletions."""
    rows = index_store.live_rows(spark, _changed(spark, d))
    return rows.select("id", "lang", "length", F.size("words").alias("terms"))


@query
def index_delete_search(spark, d):
    """Keyword search on that index."""
    return _rounded(index_store.keyword_search(spark, _changed(spark, d), _questions(spark, d), 10))


@query
def index_search(spark, d):
    """Semantic search on the stored vectors."""
    rows = index_store.live_rows(spark, _partly_stored(spark, d)).select("id", "vector")
    return _rounded(search.vector_search(rows, _embedded(spark, d), 10))


@query
def index_search_filtered(spark, d):
    """The same among the documents of one language."""
    rows = index_store.live_rows(spark, _partly_stored(spark, d))
    return _rounded(search.vector_search(rows, _embedded(spark, d), 10, filters={"lang": "fr"}))


# --- the question set ---------------------------------------------------------


def _documents_with_rate(spark: SparkSession, d: str, rate: float) -> DataFrame:
    """Documents of the cases with a royalty rate; the ids join without texts."""
    parsed = fixture.parsed_documents(spark, d)
    ids = parsed.select(
        paths.case_id(F.col("path")).alias("case_id"),
        paths.document_id(F.col("path")).alias("document_id"),
    )
    rates = cases.case_rollup(parsed.where(paths.role(F.col("path")) == "royalty"))
    found = rates.where(F.col("royalty_percentage") == rate).select("case_id")
    return ids.join(found, "case_id", "left_semi").select("document_id")


def _supplied_documents(spark: SparkSession, d: str) -> DataFrame:
    """case_id, document_id, role and supplier of every stored document."""
    path = F.col("path")
    documents = fixture.parsed_documents(spark, d).select(
        paths.case_id(path).alias("case_id"),
        paths.document_id(path).alias("document_id"),
        paths.role(path).alias("role"),
    )
    return documents.join(fixture.case_suppliers(spark, d), "case_id")


def _by_supplier(spark: SparkSession, d: str, name: str, roles: tuple[str, ...]) -> DataFrame:
    found = _supplied_documents(spark, d).where(F.lower("supplier") == name.lower())
    return found.where(F.col("role").isin(*roles)).select("supplier", "document_id")


@query
def q01(spark, d):
    return _documents_with_rate(spark, d, 3.5)


@query
def q02(spark, d):
    return _supplied_documents(spark, d).select("supplier").distinct()


@query
def q03(spark, d):
    return _royalty_documents(spark, d).select("royalty_percentage").distinct()


@query
def q04(spark, d):
    stored = fixture.case_table(spark, d).select("id", "ingestion_timestamp")
    newest = stored.agg(F.max("ingestion_timestamp")).scalar()
    return stored.where(F.col("ingestion_timestamp") == newest)


def _royalty_documents(spark: SparkSession, d: str) -> DataFrame:
    """Royalty agreements with a readable rate.

    Exploding a compacted array drops the NULLs; a filter on the rate would be
    pushed down and make Spark parse every document twice.
    """
    path = F.col("path")
    rate = fields.royalty_percentage(el.document_elements(F.col("parsed_content_translated")))
    return (
        fixture.parsed_documents(spark, d)
        .where(paths.role(path) == "royalty")
        .select(
            paths.document_id(path).alias("document_id"),
            F.explode(F.array_compact(F.array(rate))).alias("royalty_percentage"),
        )
    )


@query
def q05(spark, d):
    rates = _royalty_documents(spark, d)
    return rates.where(
        F.col("royalty_percentage") == rates.agg(F.max("royalty_percentage")).scalar()
    )


@query
def q06(spark, d):
    return anomalies_all(spark, d).orderBy("case_id", "anomaly_rule")


@query
def q07(spark, d):
    chunks = cases.document_chunks(fixture.parsed_documents(spark, d))
    return chunks.where(F.lower("text").contains("blue bolt")).select("document_id").distinct()


@query
def q08(spark, d):
    parsed = fixture.parsed_documents(spark, d).where(F.col("source_language") == "es")
    return parsed.agg(F.count_distinct(paths.document_id(F.col("path"))).alias("documents"))


@query
def q09(spark, d):
    return _by_supplier(spark, d, "Supplier#000000001", ("invoice", "declaration"))


@query
def q10(spark, d):
    return _by_supplier(spark, d, "DOES_NOT_EXIST_999", ("invoice", "declaration"))


@query
def q11(spark, d):
    return _documents_with_rate(spark, d, 99.0)


@query
def q12(spark, d):
    counts = _supplied_documents(spark, d).groupBy("supplier").agg(
        F.count(F.lit(1)).alias("documents")
    )
    return counts.orderBy(F.desc("documents"), "supplier").limit(1)


@query
def q13(spark, d):
    rate = F.col("royalty_percentage")
    return _royalty_documents(spark, d).where((rate > 2) & (rate < 6)).orderBy(
        F.desc("royalty_percentage"), "document_id"
    )


@query
def q14(spark, d):
    return _by_supplier(spark, d, "SUPPLIER#000000002", ("invoice",))
