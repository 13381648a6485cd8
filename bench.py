"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 1 timed run after one warm-up), BENCH_QUERIES (comma list).
Every query is materialised in full through the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from casewright.plans.catalog import QUERIES  # noqa: E402
from casewright.session import local_session  # noqa: E402

HEADLINE = (
    "case_inventory",
    "structured_metadata",
    "case_rollup",
    "anomalies_all",
    "extract_chunks",
    "chunks_enriched",
    "parse_elements",
    "clean_text",
    "chunk_fixed",
    "chunk_sentence",
    "chunk_paragraph",
    "detect_language",
    "merge_upsert",
    "index_delta",
    "dedup_exact",
    "knn_topk",
    "ann_lsh",
    "bm25_topk",
    "hybrid_rrf",
    "rerank_two_stage",
    "extractive_summary",
    "rag_context",
    "score_answers",
    "text_overlap_metrics",
    "session_history",
    "usage_cost",
    "log_hourly",
    "stream_log_hourly",
    "q07",
    "q13",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split(",")
    names = [n for n in names if n] or list(HEADLINE)
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)

    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries, warm",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
