"""Wall time of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (threads), BENCH_RUNS (timed runs, best counts).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import catalog  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINES = [
    "clf_parse", "ts_agg_15min", "ts_agg_1h_by_type", "ts_filled_15min", "multi_granularity", "data_summary", "hourly_profile",
    "heatmap_pivot", "describe_series", "all_features_15min", "ewm_features", "acf", "anomaly_combined", "anomaly_report",
    "metrics", "fixed_cost_curve", "strategy_compare", "sar_normal_eq", "forecast_sar", "forecast_fourier",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = int(os.environ.get("BENCH_CPUS", "8")), int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, cpus, "bench")
    times: dict[str, float] = {}
    for name in HEADLINES:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        spark.catalog.clearCache()
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "events": events, "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
