"""Benchmark: run the headline queries at ``$BENCH_SF_DIR`` (default sf0.1) on
``local[$BENCH_CPUS]`` and print one JSON line with per-query wall-clock seconds.

Each query's full result is computed and discarded through the ``noop`` sink (no collect
to the driver), after one untimed warm-up run of the flagship query at the same scale.
Every query runs ``BENCH_REPEAT`` times (default 3) and its median time is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from firmlens import catalog  # noqa: E402
from firmlens.session import local_session  # noqa: E402

HEADLINE = [
    # dashboard
    "sector_growth_top5", "sector_growth_history", "dashboard_mart", "top_sectors", "top_revenue_units",
    "establishment_card", "sector_revenue_history", "labels_in_use",
    # exploration
    "mean_by_category", "mean_top_labels", "revenue_by_commune", "log_histogram", "creations_by_commune_year",
    "pivot_creations", "top_labels", "active_by_region", "region_metric",
    # operators over the whole tables
    "geo_lambert93", "join_chain_left", "latest_per_key", "sum_by_sector_year", "period_over_period",
    # cleaning and loading pipelines (with writes)
    "clean_establishments", "clean_legal_units", "run_clean_pipeline", "monthly_staging", "daily_incremental",
    "incremental_batch",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    qs = catalog.QUERIES
    catalog.QUERIES["sector_growth_top5"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    times: dict[str, float] = {}
    for name in HEADLINE:
        took = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - t0)
        times[name] = round(median(took), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
