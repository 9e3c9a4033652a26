"""Wall time per headline query; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Every query runs to completion into the no-op sink; the figure is the median of the runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from siltstone.plans.registered import queries
from siltstone.session import build_session

HEADLINE = (
    "silver_launches",
    "silver_rockets",
    "silver_payloads",
    "silver_cores",
    "silver_solar_events",
    "mart_performance",
    "mart_roi",
    "mart_weather",
    "interval_join_trailing_24h",
    "interval_join_pm7d",
    "exploded_left_join_sum",
    "exploded_inner_join_sum",
    "json_array_unnest",
    "delete_and_insert",
    "published_incremental",
    "full_refresh_load",
    "dq_unique",
    "dq_singular_gate",
    "top5_cheapest",
    "kpi_mean_time_between",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    times = {}
    for name in chosen:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
