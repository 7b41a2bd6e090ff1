"""Times the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and three times to measure; the median counts. ``BENCH_ROWS_PER_BLOCK`` forces the
block-wise plan of oversized keys, to compare both plans on the same data.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vigil.operators.training import fit  # noqa: E402
from vigil.plans.queries import QUERIES  # noqa: E402
from vigil.plans.results import build_results, results  # noqa: E402
from vigil.session import ROWS_PER_BLOCK, local_session  # noqa: E402
from vigil.sources.canon import load_canonical  # noqa: E402

HEADLINE = (
    "stat_verdicts",
    "stage1_cached",
    "detect_stored_user_data",
    "transition_counts_user",
    "transition_counts_global",
    "win_type_count_by_type",
    "ema_deviation",
    "detect_time_deviation",
    "validate_payload",
    "flatten_event",
    "session_count_window",
    "ml_batch_features",
    "session_features",
    "ml_verdicts",
    "loss_threshold",
    "ae_train",
    "fuse_sessions",
    "fuse_idle_expiry",
    "join_ml_stat",
    "latest_stat",
    "dash_events_per_min",
    "dash_activity_breakdown",
    "dash_top_users",
    "session_rollup",
)
RUNS = 3


def timed(fn) -> float:
    start = time.perf_counter()
    fn().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "*"), app="vigil-bench")
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("BENCH_ROWS_PER_BLOCK"):
        spark.conf.set(ROWS_PER_BLOCK, os.environ["BENCH_ROWS_PER_BLOCK"])
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    results(spark, folder)
    start = time.perf_counter()
    build_results(spark, folder)
    seconds = {"pipeline_to_tables": time.perf_counter() - start}
    for name in HEADLINE:
        runs = [timed(lambda: QUERIES[name](spark, folder)) for _ in range(RUNS + 1)]
        seconds[name] = statistics.median(runs[1:])
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    metrics = fit(load_canonical(spark, folder)).metrics
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "events": events,
                "held_out_loss": round(metrics["test_loss"], 7),
                "stat_verdicts_events_per_sec": round(events / seconds["stat_verdicts"]),
            }
        )
    )


if __name__ == "__main__":
    main()
