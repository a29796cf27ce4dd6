"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_RUNS (timed runs per query, the
median counts). Every query runs to the last row into a sink that discards it. One query runs
untimed first, so that JVM start-up is not counted. `parts` times, beside the total, the first
report's production steps apart: training with sketches, and the report from stored segments.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from funnelspark.session import build_session
from funnelspark.plans import platform_health_v1, train_segments_v1
from funnelspark.sources import via_shared_table
from workload.queries import END, NOW, QUERIES, START
from workload.tables import Tables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))

HEADLINE = [
    "hour_range_scan",
    "recode_dims",
    "bid_economics",
    "predicted_metrics_v1",
    "predicted_metrics_v2",
    "cohort_d7",
    "two_level_agg",
    "primary_goal",
    "percentile_cuts_sketch",
    "percentile_cuts_exact",
    "bucket_assign",
    "target_events",
    "revenue_calibration_series",
    "funnel_v2",
    "platform_health_v2_report",
    "platform_health_v1_report",
]


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    def parts() -> dict[str, float]:
        tables = Tables(spark, FOLDER)
        started = time.perf_counter()
        segments = via_shared_table(train_segments_v1(tables["impressions"], START, END), "segments")
        trained = time.perf_counter()
        report = platform_health_v1(tables, segments, START, END, NOW)
        report.write.format("noop").mode("overwrite").save()
        return {"train_segments_v1_sketch": round(trained - started, 3), "platform_health_v1_trained": round(time.perf_counter() - trained, 3)}

    run("two_level_agg")
    seconds = {name: round(statistics.median(run(name) for _ in range(RUNS)), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "parts": parts(),
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
