"""Time the headline queries; prints one JSON line.

Each query runs once to warm up, then BENCH_RUNS times (default 3); the median counts.
Results go to the no-op sink, so the whole result is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from gridloom.catalog import QUERIES
from gridloom.session import build_session

HEADLINE = [
    "model_input",
    "weighted_job_load",
    "load_by_systems",
    "job_load_per_system",
    "interpolate_linear_limit",
    "interpolate_linear_limit_chunked",
    "interpolate_cubic",
    "forward_fill",
    "pivot_fields",
    "nearest_locations",
    "systems_near_sites",
    "combine_sources",
    "weather_latest",
    "weather_by_run",
    "predicted_load",
    "prediction_components_quantiles",
    "predicted_load_tahead",
    "horizon_hours",
    "latest_coefficients",
    "solar_input",
    "splitting_input",
    "prediction_jobs",
    "write_forecast",
    "stream_realised",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            begun = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begun)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
