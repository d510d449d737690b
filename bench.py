"""Seconds per headline query: median of warm runs, as one JSON line.

BENCH_SF_DIR names the tables and BENCH_CPUS the local cores. Every run computes the whole
result (``noop`` sink) and nothing is cached between runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cardwarden.catalog import all_queries  # noqa: E402
from cardwarden.session import local_session  # noqa: E402

HEADLINE = (
    "top_categories",
    "suspicious_card_days",
    "error_rate_by_client",
    "card_risk_features",
    "card_risk_score",
    "segment_comparison",
    "velocity",
    "impossible_travel",
    "amount_stats",
    "summary",
    "fraud_label_eval",
    "lineitem_card_daily_stats",
    "lineitem_suspicious_card_days",
    "lineitem_card_risk_score",
    "lineitem_segment_comparison",
)
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def seconds(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def scale(folder: str) -> float | str:
    name = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores)
    queries = all_queries()
    measured = {}
    for name in HEADLINE:
        seconds(queries[name], spark, folder)
        runs = [seconds(queries[name], spark, folder) for _ in range(RUNS)]
        measured[name] = round(statistics.median(runs), 4)
    spark.stop()
    line = {
        "metric": "headline_total",
        "value": round(sum(measured.values()), 4),
        "unit": "sec",
        "queries": measured,
        "sf": scale(folder),
        "cores": cores,
        "runs": RUNS,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
