"""Headline timings: one JSON line on standard output.

Every query runs from the parquet tables (no stage shared with another query)
except those marked STAGED, whose input stage is written before the clock
starts. The shorter of two runs is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time

from catalogue import QUERIES
from catalogue.base import features, predictions
from riskloom.session import build_session
from riskloom.sources.star import Star

FROM_TABLES = (
    "flagship_current_risk", "ag05_distinct_counts", "ag10_returns_monthly", "ag12_opportunity_monthly", "ag13_market_activity_monthly", "ag21_describe",
    "ag24_monthly_actuals", "jn12_return_to_sale", "fn08_date_parts", "wn12_average_rank_share",
    "wn19_global_row_number", "prj26_effective_start", "dq03_primary_keys", "dq05_foreign_keys",
)
STAGED = (
    "ag01_customer_product_monthly", "ag02_monthly_sales", "ag04_quota_month",
    "wn03_rolling_means", "wn06_slopes", "fe01_risk_flags", "fe13_peer_benchmarks", "ml01_time_split", "ml03_numeric_state",
    "ml14_summary_metrics", "ml15_roc_auc", "ml16_average_precision", "ro11_alert_queue", "ro14_threshold_tradeoff",
)


def timed(run) -> float:
    best = float("inf")
    for _ in range(2):
        start = time.perf_counter()
        run().write.mode("overwrite").format("noop").save()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    results: dict[str, float] = {}
    for name in FROM_TABLES:
        results[name] = timed(lambda: QUERIES[name](spark, directory))
        print(name, results[name], file=sys.stderr)
    results["canonical_sales_written"] = timed(lambda: Star(spark, directory).written().sales.select("transaction_id"))
    print("canonical_sales_written", results["canonical_sales_written"], file=sys.stderr)
    results["feature_table_from_raw"] = timed(lambda: Star(spark, directory).written().features())
    print("feature_table_from_raw", results["feature_table_from_raw"], file=sys.stderr)
    star = Star(spark, directory)
    features(star), predictions(star)
    for name in STAGED:
        results[name] = timed(lambda: QUERIES[name](spark, directory))
        print(name, results[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(results.values()), 3), "unit": "sec",
                "queries": results, "sf": directory.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
