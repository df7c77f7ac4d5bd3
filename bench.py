"""Time the headline queries and print one JSON line.

Every query runs once to warm up and is then timed over a full ``noop`` write.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "hour_rollup hour_rollup_first_label latest_per_hour bucket_5min top2_per_key dedupe_key "
    "master_hour master_5min_gated full_coverage_spine pivot_series bounded_by_scalar "
    "asof_nearest asof_tolerance previous_and_next range_slice_origins "
    "grid_regular interp_linear_limit interp_onto_instants interp_local_cubic ffill_bfill "
    "replicate_12x5min rms_gap_fill direction_compass signed_intensity "
    "lags moving_mean_long feature_matrix feature_matrix_single_series sequence_windows "
    "split_80_10_10 timeseries_folds minmax_fit_apply naive_baseline_metrics metrics_by_horizon "
    "audit_view merge_freeze rolling_refresh profile_columns json_forecast_list safe_cast_comma "
    "stream_bucket stream_hour_rollup recursive_forecast"
).split()


def main() -> None:
    from tidewright.catalog import QUERIES
    from tidewright.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = build_session("bench", master=f"local[{cpus}]")
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        for attempt in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
