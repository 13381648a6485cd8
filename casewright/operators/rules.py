"""Consistency rules over case-level amounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOTALS = ("invoice_total", "declaration_invoice_total", "declaration_total")


def _differs(a: Column, b: Column, tolerance: float) -> Column:
    return (a != b) if tolerance == 0 else (F.abs(a - b) > tolerance)


def rules(tolerance: float = 0.0) -> dict[str, Column]:
    """Rule label -> condition.  NULL counts as "not violated"."""
    parts = ("declaration_tax_A", "declaration_tax_B", "declaration_VAT", "declaration_royalty")
    declared_sum = F.col("declaration_invoice_total")
    for p in parts:
        declared_sum = declared_sum + F.coalesce(F.col(p), F.lit(0.0))
    return {
        "INVOICE_TOTAL_MISMATCH": _differs(
            F.col("invoice_total"), F.col("declaration_invoice_total"), tolerance
        ),
        "DECLARATION_TOTAL_MISMATCH": _differs(
            F.round(declared_sum, 2), F.col("declaration_total"), tolerance
        ),
        "ROYALTY_MISMATCH": F.col("royalty_percentage").isNotNull()
        & F.col("declaration_royalty").isNull(),
    }


def violated(tolerance: float = 0.0) -> Column:
    """array<string> of the violated rules of a row."""
    labels = F.array(*[F.when(cond, F.lit(label)) for label, cond in rules(tolerance).items()])
    return F.filter(labels, lambda x: x.isNotNull())


def detect_anomalies(
    rows: DataFrame, anomaly_type: str | None = None, tolerance: float = 0.0
) -> DataFrame:
    """Violations per (case, rule) with the greatest totals seen.

    ``rows`` may be the case rollup or the chunk table, where each chunk
    repeats the fields of its case.  All rules are tested in one scan; an
    unknown ``anomaly_type`` gives no rows.  Sort at the consumer.
    """
    hits = rows.select("case_id", F.explode(violated(tolerance)).alias("anomaly_rule"), *TOTALS)
    if anomaly_type is not None:
        hits = hits.where(F.col("anomaly_rule") == anomaly_type)
    return hits.groupBy("case_id", "anomaly_rule").agg(*[F.max(t).alias(t) for t in TOTALS])


def register_detect_anomalies(
    spark: SparkSession, source: str, name: str = "detect_anomalies"
) -> None:
    """Create the SQL table function over a table or view called ``source``."""
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(anomaly_type STRING DEFAULT NULL)
        RETURNS TABLE(case_id STRING, anomaly_rule STRING, invoice_total DOUBLE,
                      declaration_invoice_total DOUBLE, declaration_total DOUBLE)
        RETURN
        SELECT case_id, anomaly_rule, max(invoice_total), max(declaration_invoice_total),
               max(declaration_total)
        FROM {source}
        LATERAL VIEW explode(array_compact(array(
            IF(invoice_total <> declaration_invoice_total, 'INVOICE_TOTAL_MISMATCH', NULL),
            IF(round(declaration_invoice_total + coalesce(declaration_tax_A, 0)
                     + coalesce(declaration_tax_B, 0) + coalesce(declaration_VAT, 0)
                     + coalesce(declaration_royalty, 0), 2) <> declaration_total,
               'DECLARATION_TOTAL_MISMATCH', NULL),
            IF(royalty_percentage IS NOT NULL AND declaration_royalty IS NULL,
               'ROYALTY_MISMATCH', NULL)))) AS anomaly_rule
        WHERE detect_anomalies.anomaly_type IS NULL
           OR anomaly_rule = detect_anomalies.anomaly_type
        GROUP BY case_id, anomaly_rule
        """.replace("detect_anomalies.anomaly_type", f"{name}.anomaly_type")
    )
