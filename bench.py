"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketlake.session import build_session  # noqa: E402
from basketlake.sources import sample  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINE = (
    "top_movers", "sales_by_department", "tender_analysis", "loss_report", "seasonal_trends", "promotion_performance",
    "dead_stock", "cashier_void_rate", "rollup_dept", "enrich_lines", "secret_scan", "load_summary", "tender_stamp",
    "movement_parse", "rollup_item", "basket_affinity", "basket_pairs", "diff_scan", "transaction_islands", "item_master_build",
    "search_by_name", "store_comparison", "monthly_revenue",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    start = time.perf_counter()
    sample.stored_detail(spark, sf_dir)
    seconds["build_detail"] = round(time.perf_counter() - start, 3)
    print("build_detail", seconds["build_detail"], file=sys.stderr, flush=True)
    start = time.perf_counter()
    sample.stored_rollups(spark, sf_dir)
    seconds["build_rollups"] = round(time.perf_counter() - start, 3)
    print("build_rollups", seconds["build_rollups"], file=sys.stderr, flush=True)
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "enrich_rows_per_sec": round(lines / seconds["enrich_lines"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
