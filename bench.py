"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the data folder, BENCH_CPUS the
local cores, BENCH_RUNS the timed runs after one warm-up (best is kept),
BENCH_QUERIES an optional comma list ("all" for every registered query).
"""

from __future__ import annotations

import json
import os
import re
import time

import pyspark

from bazaarlens.plans import registry
from bazaarlens.session import local_session

HEADLINE = [
    "monthly_order_kpis", "monthly_sales_kpis", "packages", "sales_enriched", "category_basket", "cargo_allocation", "product_segments",
    "segment_summary", "model_pairs_by_lift", "multicolor_models", "customers", "repurchase_gaps", "cohort_retention", "amount_bins",
    "net_histogram", "fulfilment_summary", "distribution_totals", "scenario_grid", "margin_curve", "coupon_scenarios", "coverage_by_month",
    "package_rollup_ingest", "order_line_rollup", "union_keep_last", "parse_locale_numbers",
]


def run(spark, build, folder: str) -> float:
    start = time.perf_counter()
    build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    found = registry.queries()
    picked = os.environ.get("BENCH_QUERIES", "")
    names = list(found) if picked == "all" else [n for n in picked.split(",") if n] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    best = {}
    for name in names:
        first = run(spark, found[name], folder)
        best[name] = round(min([run(spark, found[name], folder) for _ in range(runs)], default=first), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(best.values()), 3), "unit": "sec", "queries": best,
        "sf": float(scale.group(1)) if scale else None, "cores": cpus, "spark": pyspark.__version__, "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
