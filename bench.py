"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the input.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from wattlane.plans.catalog import catalog  # noqa: E402
from wattlane.session import build_session  # noqa: E402

HEADLINE = [
    "rolling_mean_past",
    "lag_features",
    "persistence_baseline",
    "strategy_sweep",
    "alpha_by_standardize_grid",
    "alpha_cv",
    "refit_and_test",
    "series_stats",
    "concentration",
    "correlation_matrix",
    "autocorrelation_profile",
    "error_by_level",
    "drift_report",
    "score_requests",
    "govern_decision",
    "sample_n",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
            # The tables compress to a few megabytes, so the usual sizes would leave most
            # cores without a partition.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            "spark.sql.files.openCostInBytes": "128k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog().queries
    # Start-up and code loading are not part of any query.
    queries["fleet_total"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
