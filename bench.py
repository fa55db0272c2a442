"""Time the headline queries and print one JSON line.

Every query reads the given tables and writes nowhere; earlier stages that a query reads are stored
before its clock starts, as in a daily run; what storing took is printed stage by stage. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import queries as Q  # noqa: E402
from oreline.session import build_session  # noqa: E402

HEADLINE = [
    "silver_orders", "silver_transactions_fraud", "silver_customers", "txn_velocity", "fraud_baseline",
    "upsert", "scd2_customers", "customer_order_metrics", "customer_txn_metrics", "customer_360",
    "daily_order_summary", "fraud_summary", "vw_revenue_trend", "vw_fraud_dashboard",
    "er_reduction_ratio", "er_matches", "er_resolved", "graph_customer_360", "fraud_rings", "product_affinity",
    "merchant_risk", "churn_contagion", "customer_pagerank", "fact_orders", "dq_suite", "serve_order_summary",
]
STAGES = [Q.b_orders, Q.b_txns, Q.b_customers, Q.txn_history, Q.s_orders, Q.s_txns, Q.s_customers, Q.entity_map, Q.m_360, Q.m_daily, Q.m_fraud]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    stages, seconds = {}, {}
    for stage in STAGES:  # each reads what the ones before it have stored
        start = time.perf_counter()
        stage(spark, sf_dir)
        stages[stage.__name__] = round(time.perf_counter() - start, 3)
        print(f"stored {stage.__name__}: {stages[stage.__name__]}", file=sys.stderr, flush=True)
    for name in HEADLINE:
        start = time.perf_counter()
        Q.REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "stored_stages": stages, "stored_total": round(sum(stages.values()), 3)}))


if __name__ == "__main__":
    main()
