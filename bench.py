"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line. Each query is built and run once to warm up and then
``$BENCH_RUNS`` times (3); its time is the median of those.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from retailmart import catalog
from retailmart.session import local_session

HEADLINES = (
    # e-commerce analyses
    "kpi_dashboard",
    "top_transactions",
    "discount_impact",
    "campaign_ab",
    "top_products",
    "category_share",
    "price_segments",
    "top_campaigns",
    "channel_share",
    "objective_performance",
    "campaign_efficiency",
    "month_over_month",
    "quarterly_demand",
    "customer_segments",
    "top_customers",
    "country_performance",
    "event_distribution",
    "channel_funnel_counts",
    "funnel_conversion",
    "session_duration_by_age",
    # cafe analyses
    "monthly_contribution",
    "weekday_sales",
    "item_pareto",
    "spend_buckets",
    # profiling, cleaning and gold views over whole facts
    "dq_missing_transactions",
    "dq_duplicate_keys_transactions",
    "dq_duplicate_rows_transactions",
    "dq_orphan_keys_transaction_customer",
    "dq_frequency_event_session",
    "cl_cafe_silver",
    "cl_ecommerce_silver_transactions",
    "gv_sales_base",
    "gv_customer_behavior",
    "gv_event_behavior",
)


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session()
    queries = catalog.queries()
    names = sys.argv[1:] or HEADLINES
    times = {}
    for name in names:
        run(queries[name], spark, sf_dir)
        times[name] = round(
            statistics.median(run(queries[name], spark, sf_dir) for _ in range(runs)), 3
        )
    print(
        json.dumps(
            {
                "metric": "median warm time of all headline queries, summed",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
