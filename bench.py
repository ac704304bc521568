"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cadenza.queries import QUERIES  # noqa: E402
from cadenza.session import local_session  # noqa: E402

HEADLINE = [
    "hourly_sum", "densify_hourly", "densify_daily", "history_with_spots", "weather_clean", "panel_with_weather",
    "time_features", "delta_features", "chrono_split", "rolling_folds", "backtest_origins", "windows_long",
    "window_targets", "feature_scaler", "scaled_panel", "naive_season", "metrics_by_spot", "model_comparison",
    "histogram_50", "corr_matrix", "quality_summary", "label_at_horizon", "forecast_naive", "backtest_naive",
    "rolling_naive", "xml_rows", "pending_work", "ingest_resume", "gbt_score", "second_learner",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=max(int(cores), 1))
    QUERIES[HEADLINE[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
