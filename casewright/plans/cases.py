"""A case collection derived from orders and line items.

No customs documents ship with the driver tables, so every order with line
items becomes a complete case of two or three parsed documents.  Amounts are
integer cents printed as text, which makes any expected value a matter of
plain arithmetic on the source tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casewright.functions.elements import ELEMENT_TYPE

_KEY_BITS = 40


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the files once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: key, date, cents and first supplier and part.

    ``cents`` is NULL for an order without line items.  The line items are
    summed before the join, so a huge order is combined on the map side.
    """
    lines = table(spark, sf_dir, "lineitem")
    # "Value at the first line" as a plain long minimum: the line number sits
    # in the high bits.  A struct or string minimum would force a sort-based
    # aggregate, a long one stays in the hash aggregate.
    high = F.col("l_linenumber").cast("long") * (1 << _KEY_BITS)
    sums = lines.groupBy("l_orderkey").agg(
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents"),
        F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
        (F.min(high + F.col("l_suppkey")) % (1 << _KEY_BITS)).alias("suppkey"),
        (F.min(high + F.col("l_partkey")) % (1 << _KEY_BITS)).alias("partkey"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("ordered")
    )
    return (
        orders.join(sums, F.col("k") == F.col("l_orderkey"), "left")
        .drop("l_orderkey")
        .withColumn("case_id", F.concat(F.lit("case_"), F.col("k")))
    )


def case_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder listing: one ``path`` per file, some of them irrelevant."""
    k = F.col("k").cast("string")
    base = F.concat(F.lit("/cases/case_"), k, F.lit("/"))

    def file(prefix: str, suffix: str) -> Column:
        return F.concat(base, F.lit(prefix), k, F.lit(suffix))

    names = F.array(
        file("invoice_", ".pdf"),
        F.when(F.col("cents").isNotNull(), file("declaration_", ".pdf")),
        F.when(F.col("k") % 5 == 0, file("royalty_", ".PDF")),
        file("scan_", ".pdf"),
        file("declaration_", ".txt"),
        F.concat(F.lit("/cases/notes_"), k, F.lit("/invoice_"), k, F.lit(".pdf")),
    )
    return (
        order_facts(spark, sf_dir)
        .select(F.explode(names).alias("path"))
        .where(F.col("path").isNotNull())
    )


def run_stamp(ts: Column) -> Column:
    """yyyyMMddHHmm as a number."""
    return F.date_format(ts, "yyyyMMddHHmm").cast("long")


def case_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The case metadata of all complete cases."""
    k = F.col("k").cast("string")
    base = F.concat(F.lit("/cases/case_"), k, F.lit("/"))

    def file(role: str) -> Column:
        return F.concat(base, F.lit(f"{role}_"), k, F.lit(".pdf"))

    return (
        order_facts(spark, sf_dir)
        .where(F.col("cents").isNotNull())
        .select(
            F.col("case_id").alias("id"),
            file("invoice").alias("invoice_path"),
            file("declaration").alias("declaration_path"),
            F.when(F.col("k") % 5 == 0, file("royalty")).alias("royalty_path"),
            F.date_format("ordered", "yyyy-MM-dd'T'HH:mm:ss").alias("ingestion_timestamp"),
            run_stamp(F.col("ordered")).alias("processed"),
            F.concat(F.lit("/cases/case_"), k).alias("volume_path"),
        )
    )


def case_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """case_id and supplier of every complete case whose supplier is known."""
    return (
        order_facts(spark, sf_dir)
        .where(F.col("cents").isNotNull())
        .join(table(spark, sf_dir, "supplier"), F.col("suppkey") == F.col("s_suppkey"))
        .select("case_id", F.col("s_name").alias("supplier"))
    )


# The document generator is plain SQL text: one parse instead of hundreds of
# column calls.  Names: k key, c cents, cur currency.
_CUR = "element_at(array('eur', 'usd', 'gbp'), CAST(k % 3 + 1 AS INT))"
_TAX_A = "c * 5 DIV 100"
_TAX_B = "c * 3 DIV 100"
_VAT = "c * 21 DIV 100"
_ROYALTY = "c * (k % 9 * 2 + 1) DIV 200"
_HAS_TAX_B = "k % 2 = 0"
_HAS_ROYALTY = "k % 5 = 0 AND k % 15 <> 0"
_TOTAL = (
    f"c + {_TAX_A} + IF({_HAS_TAX_B}, {_TAX_B}, 0) + {_VAT} "
    f"+ IF({_HAS_ROYALTY}, {_ROYALTY}, 0) + IF(k % 11 = 0, 1000, 0)"
)


def _money(cents: str) -> str:
    return f"concat(({cents}) DIV 100, '.', lpad(CAST(({cents}) % 100 AS STRING), 2, '0'))"


def _row(*cells: str, tag: str = "td", when: str | None = None) -> str:
    """SQL for a table row of SQL cell expressions, empty unless ``when``."""
    parts = ", ".join(f"'<{tag}>', {cell}, '</{tag}>'" for cell in cells)
    row = f"concat('<tr>', {parts}, '</tr>')"
    return row if when is None else f"IF({when}, {row}, '')"


def _element(id_: str, kind: str, content: str) -> str:
    return f"named_struct('id', {id_}, 'type', '{kind}', 'content', {content})"


def _document(role: str, *elements: str) -> str:
    return (
        f"named_struct('path', concat('/cases/case_', k, '/{role}_', k, '.pdf'), "
        f"'elements', CAST(array({', '.join(elements)}) AS array<{ELEMENT_TYPE}>))"
    )


_INVOICE = _document(
    "invoice",
    _element("'i0'", "section_header", "concat('Commercial invoice ', k)"),
    _element(
        "'i1'",
        "text",
        "concat('Goods sup-\\nplied by ', supplier, '.\\n  Article: ', part, '.')",
    ),
    _element("'i2'", "page_footer", "'Page 1'"),
    _element("'i3'", "text", "''"),
    _element(
        "'i4'",
        "table",
        "concat('<table>', "
        + ", ".join(
            (
                _row("'No'", "'Article'", "'Qty'", "'Unit'", "'Note'", "'Amount'", "'Cur'", tag="th"),
                _row("'1'", "part", "quantity", "'pcs'", "'new &amp; boxed'", _money("c"), "cur"),
                _row(
                    "''", "''", "''", "''", "'<b>Total</b>'",
                    f"concat(' ', {_money('c + IF(k % 7 = 0, 100, 0)')})", "cur",
                ),
            )
        )
        + ", '</table>')",
    ),
)
_DECLARATION = _document(
    "declaration",
    _element("'d0'", "section_header", "concat('Import declaration ', k)"),
    _element(
        "CAST(NULL AS STRING)",
        "table",
        "concat('<table>', "
        + ", ".join(
            (
                _row("'Item'", "'Base'", "'Amount'", "'Currency'", tag="th"),
                _row("'Invoice'", "''", _money("c"), "cur"),
                _row("'Tax A'", "'5&nbsp;%'", _money(_TAX_A), "cur"),
                _row("'Tax B'", "'3&nbsp;%'", _money(_TAX_B), "cur", when=_HAS_TAX_B),
                _row("'VAT'", "'21&nbsp;%'", _money(_VAT), "cur"),
                _row("'Royalty'", "''", _money(_ROYALTY), "cur", when=_HAS_ROYALTY),
                _row("'Total'", "''", _money(_TOTAL), "cur"),
            )
        )
        + ", '</table>')",
    ),
)
_ROYALTY_AGREEMENT = _document(
    "royalty",
    _element("'r0'", "section_header", "concat('Royalty agreement ', k)"),
    _element(
        "'r1'",
        "text",
        "concat('The licensee pays a royalty of ', k % 9, ',5 % on net sales.')",
    ),
)


def parsed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed documents of all complete cases, one row per file."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    facts = (
        order_facts(spark, sf_dir)
        .where(F.col("cents").isNotNull())
        .join(suppliers, F.col("suppkey") == F.col("s_suppkey"), "left")
        .join(parts, F.col("partkey") == F.col("p_partkey"), "left")
        .selectExpr(
            "k",
            "cents AS c",
            "quantity",
            "coalesce(s_name, 'unknown') AS supplier",
            "coalesce(p_name, 'unknown') AS part",
            f"{_CUR} AS cur",
            "CAST(date_format(ordered, 'yyyyMMddHHmm') AS BIGINT) AS processed",
            "element_at(array('en', 'es', 'fr', 'de'), CAST(k % 4 + 1 AS INT)) AS source_language",
        )
    )
    return (
        facts.selectExpr(
            "processed",
            "source_language",
            f"inline(array_compact(array({_INVOICE}, {_DECLARATION}, "
            f"IF(k % 5 = 0, {_ROYALTY_AGREEMENT}, NULL)))) AS (path, elements)",
        )
        .selectExpr(
            "path",
            "to_json(named_struct('document', named_struct('elements', elements))) "
            "AS parsed_content",
            "processed",
            "source_language",
        )
        .selectExpr(
            "path",
            "parsed_content",
            "processed",
            "parsed_content AS parsed_content_translated",
            "source_language",
            "source_language <> 'en' AS translation_applied",
        )
    )
