"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (table folder), BENCH_CPUS (local cores) and BENCH_REPEAT (timed runs per
query; the fastest counts) come from the environment.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "slot_profile", "entity_std", "entity_quantiles", "rank_in_day", "velocity", "impute_temperature", "foldsafe_te",
    "foldsafe_te_5", "target_day_features", "knn_warm", "knn_cold", "same_slot_lookup", "spatial_lag", "model_r2",
    "bucket_metrics", "spatial_breakdown", "residual_stats", "value_distribution_lineitem", "blend_weights",
    "calibration_grid", "history_features_all", "feature_matrix",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))

    from slotcast.queries import QUERIES
    from slotcast.session import build_session

    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["model_r2"](spark, sf_dir).count()  # starts the JVM's compiler on the common path
    seconds = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(repeat):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
