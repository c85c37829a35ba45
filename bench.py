"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tallyhouse.catalog import QUERIES
from tallyhouse.session import build_session

HEADLINE = [
    "monthly_domain_kpis", "monthly_global_and_domain_rollup", "payment_split_by_month", "first_full_month_value",
    "nth_order_club", "new_payment_cohort", "three_month_average", "order_union_multiset", "churn_score",
    "plan_churn_tiered", "payment_churn_value_lost", "invoice_item_revenue", "invoice_status_buckets",
    "latest_subscription_per_domain", "receivable_tree", "payment_schedule", "purchase_merge_latest",
    "duplicate_payments", "freight_order_list", "freight_reconciliation", "client_inferred_brands",
    "deal_last_meeting_asof", "weekly_matrix_zero_filled", "tiered_plan_match", "fuzzy_ticket_match",
    "company_groups", "feature_flags_month", "global_month_series", "company_mart",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/region.parquet").groupBy("r_name").count().collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale) if scale.replace(".", "").isdigit() else scale}))
    spark.stop()


if __name__ == "__main__":
    main()
