"""Time the headline queries. Prints one JSON line.

``BENCH_SF_DIR`` names the folder, ``BENCH_CPUS`` the cores. Each query writes all its
rows to a sink that drops them. Full refreshes rebuild every layer from the given
tables; the other queries read the layers, built before they are timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.catalog import QUERIES  # noqa: E402
from tessera.plans.warehouse import warehouse  # noqa: E402
from tessera.session import local_session  # noqa: E402

REFRESHES = ["a14_replay_retail", "a15_replay_finance"]
HEADLINE = [
    "b6_silver_summary", "b4_dedupe_first", "c3_gold_summary", "a16_inject_schema_drift", "d2_slice", "d3_dice",
    "d4_drill_down", "d5b_rollup_levels", "d6_pivot_matrix", "d7_oltp_status_summary", "d8_channel_summary",
    "c1_star_join", "l2_top_products", "l3_revenue_by_country_quarter", "g2_finance_summary", "c6_vendor_canonicalisation",
    "c4_enrich_silver", "d12_spend_by_dept_month", "e1_pareto_rank", "d15_drill_dept", "d17_daily_trend", "d23_kpis",
    "d24_dow_pattern", "d26_median_amount", "e3_next_month_forecast", "e4_j4_revenue_forecast", "e5_e6_concentration",
    "c2_j8_customer_features", "j5_f3_association_rules", "q2_foreign_keys_resolve", "q3_unique_dim_keys",
]
MODELS = ["j1_d28_cluster_summary", "j2_churn_classifier", "j6_d29_confusion", "j7_spend_anomaly_summary", "i2_bronze_to_silver_stream"]
WARM_RUNS = 3
# A query slower than this is repeated once only.
SLOW = 3.0


def main() -> None:
    source = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "tessera-bench")
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, source).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timed: dict[str, float] = {}
    start = time.perf_counter()
    warehouse(spark, source).register_views()
    layers_built = time.perf_counter() - start
    for name in REFRESHES + MODELS:
        timed[name] = run(name)
    for name in HEADLINE:
        first = run(name)
        timed[name] = statistics.median(run(name) for _ in range(1 if first > SLOW else WARM_RUNS))
    rows = warehouse(spark, source).table("bronze_sales_raw").count()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": {name: round(seconds, 3) for name, seconds in timed.items()},
        "sf": source,
        "first_build_of_all_layers_sec": round(layers_built, 3),
        "retail_replay_rows_per_sec": round(rows / timed["a14_replay_retail"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
