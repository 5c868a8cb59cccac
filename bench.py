"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kilowatch.session import build_spark  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "clean_readings", "hourly_rollup", "meter_stats", "dedup_readings", "peak_hours",
    "monthly_trend", "top_consumers", "weekend_weekday", "weather_correlation", "tariff_by_hour",
    "daily_consumption", "score_readings", "score_7d_window", "anomaly_breakdown",
    "anomaly_rate_trend", "hourly_anomaly_counts", "top_anomaly_meters", "open_alerts",
    "meter_state_latest", "injection_validation", "demand_lags", "feature_frame",
    "forecast_accuracy", "forecast_vs_actual", "score_stream",
]


def main() -> None:
    spark = build_spark(
        "kilowatch-bench", f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    from kilowatch.plans.registry import QUERIES

    names = sys.argv[1:] or HEADLINE
    # One untimed query starts the executors, the Python workers and the code cache.
    QUERIES["peak_hours"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    readings = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    extra = {"readings": readings}
    for name in ("score_readings", "score_stream"):
        if name in seconds:
            extra[f"{name}_rows_per_sec"] = round(readings / seconds[name])
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), **extra,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
