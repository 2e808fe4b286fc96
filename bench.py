"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores,
BENCH_QUERIES a comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = [
    "market_rollup", "clean_row_stats", "market_features", "segment_rollup", "fact_dim_join",
    "distinct_values", "outlier_rate", "lineitem_profile", "date_grain", "clip_1_99",
    "pair_correlations", "channel_groups", "column_subtypes", "model_routes", "gate_decision",
    "bocpd_probs", "cp_candidates", "model_matrix", "mmm_map", "integration_report",
    "psi_segment", "psi_numeric",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["date_rollup"](spark, folder).collect()  # start the workers and warm the reader
    times = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
