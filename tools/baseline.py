"""Native plans beside row-at-a-time Python versions of the same operators.

usage: python tools/baseline.py [folder] [cores]

Prints one line per operator: median seconds of three runs after a warm-up.
The case documents are written once beforehand, so their generation is not
part of any figure.
"""

from __future__ import annotations

import html
import json
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from casewright.functions import paths, text  # noqa: E402
from casewright.operators import cases  # noqa: E402
from casewright.plans.cases import parsed_documents, table  # noqa: E402
from casewright.session import local_session, shared_folder  # noqa: E402

RUNS = 3


def clean_row(t: str) -> str:
    return re.sub(r"\s+", " ", re.sub(r"(\w)-\s*\n\s*(\w)", r"\1\2", t)).strip()


def chunk_row(t: str) -> list[str]:
    return [t[s : s + 500] for s in range(0, len(t), 450)]


def invoice_row(parsed: str) -> tuple[float | None, str | None]:
    tables = [e["content"] for e in json.loads(parsed)["document"]["elements"] if e["type"] == "table"]
    rows = re.findall(r"<tr>(.*?)</tr>", tables[-1] if tables else "", re.S)
    cells = [html.unescape(re.sub(r"<[^>]+>", "", c)).strip() for c in re.findall(r"<td>(.*?)</td>", rows[-1])]
    return (float(cells[5]), cells[6].upper()) if len(cells) >= 7 else (None, None)


def seconds(df) -> float:
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return statistics.median(times[1:])


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cores = sys.argv[2] if len(sys.argv) > 2 else "8"
    spark = local_session(cores)
    stored = shared_folder(spark, "baseline")
    parsed_documents(spark, folder).repartition(int(cores), "path").write.parquet(stored)
    parsed = spark.read.parquet(stored)
    invoices = parsed.where(paths.role(F.col("path")) == "invoice")
    texts = table(spark, folder, "documents").select("doc_id", "text").repartition(int(cores), "doc_id")
    content = F.col("parsed_content_translated")
    pairs = {
        "clean_text": (
            texts.select(text.clean_text(F.col("text"))),
            texts.select(F.udf(clean_row)(F.col("text"))),
        ),
        "chunk_fixed": (
            texts.select(F.explode(text.fixed_chunks(F.col("text")))),
            texts.select(F.explode(F.udf(chunk_row, "array<string>")(F.col("text")))),
        ),
        "invoice_fields": (
            cases.document_fields(invoices).select("invoice_total", "invoice_currency"),
            invoices.select(F.udf(invoice_row, "amount double, currency string")(content)),
        ),
    }
    for name, (native, by_row) in pairs.items():
        print(f"{name:16s} native {seconds(native):7.3f} s   row by row {seconds(by_row):7.3f} s", flush=True)


if __name__ == "__main__":
    main()
