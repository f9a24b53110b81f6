"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder (default sf0.1), BENCH_CPUS the local cores. Each query is run once to warm up and
then BENCH_RUNS times (default 2); the best run counts. Results are fully computed and discarded, never collected.
"""

from __future__ import annotations

import json
import os
import platform
import time

from pyspark.sql import SparkSession

from jobtide.plans.catalog import QUERIES

HEADLINE = [
    "flow_by_state", "flow_by_family_code", "flow_by_municipality", "flow_all_grains", "market_cube", "adjustment_breakdown",
    "weighted_median", "trend", "deflated_salary", "rates_per_100k", "ranked_rate_topk", "rank_within_state",
    "territory_comparison", "quarter_summary", "family_trend", "net_negative_guard", "rows_with_base", "flow_quality_report",
    "national_audit", "flow_scope_rows", "stock_cube", "stock_by_state_share", "stock_by_municipality", "stock_partition_counts",
    "reject_routing", "stock_rule_candidates", "dimension_check", "regional_reconciliation", "stock_flow_context",
    "stock_flow_by_code", "value_profile", "national_reconciliation", "gate_summary", "history_snapshot", "history_evaluation",
    "rebuilt_months", "file_manifests", "comparable_values",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("jobtide-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        best = None
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - start
            best = elapsed if best is None else min(best, elapsed)
        seconds[name] = round(best, 3)
    version = spark.version
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": version,
                "machine": platform.machine(),
            }
        )
    )


if __name__ == "__main__":
    main()
