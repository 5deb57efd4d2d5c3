"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rowloom.plans.catalog import QUERIES  # noqa: E402
from rowloom.session import session  # noqa: E402

HEADLINE = [
    "feature_table",
    "num_agg",
    "entity_rollup",
    "window_rollup",
    "status_slice_rollup",
    "time_weighted_mean",
    "trend_slope",
    "two_level_rollup",
    "two_hop_rollup",
    "last_k_rollup",
    "latest_values",
    "nunique_any",
    "pivot_count",
    "recent_overall_ratio",
    "group_transform",
    "label_child_rows",
    "semi_members",
    "rank_normalize",
    "roc_auc",
    "stratified_folds",
    "frequency_encode",
    "groupby_ratio",
    "target_encode_oof",
    "knn_target_mean",
    "corr_filter",
    "blend_candidates",
    "weight_search_by_fold",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("OFF")
    times: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(repeats):  # the first run also warms the JVM; the best one counts
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
