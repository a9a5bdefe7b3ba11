"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from ontime.catalog import QUERIES  # noqa: E402
from ontime.session import builder  # noqa: E402

HEADLINES = (
    "decode_packed", "hourly_weather", "previous_leg_flag", "silver_flights", "silver_flights_airport",
    "enriched_flights", "avg_delay_by_state", "delays_by_weekday_route_origin", "mean_delay_pivot",
    "group_stats_volume", "correlation_matrix", "correlation_matrix_enriched", "regression_metrics",
    "column_profile", "validate_profile", "drift_distance", "pagerank", "pagerank_top_k", "arrival_board",
    "fit_random_forest", "fit_boosted_trees",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder("ontime-bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["enriched_flights"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up the JVM
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name,
            }
        )
    )


if __name__ == "__main__":
    main()
