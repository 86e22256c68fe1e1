"""Benchmark: run the headline jobs and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each job is executed in full with the ``noop`` sink (every row computed,
nothing gathered on the driver). Before timing, every headline job runs
once untimed on the smallest scale factor, so one-off JVM start-up and
code generation are not counted; the reported value is the sum of the
timed job runs at ``BENCH_SF_DIR``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "label_counts_by_state", "sentiment_scores", "sentiment_struct", "sentiment_rules_posts", "topic_flags",
    "state_first",
    "state_matches", "gazetteer_state", "state_sentiment", "majority_label", "describe_by_state",
    "histogram_compound", "value_counts_label", "ratios", "flatten_props", "first_text", "track_keywords",
    "between_times", "route_messages", "capture_filter", "standardize_events", "assign_clusters",
    "elbow_lineitem", "kmeans_events", "kmeans_elbow_events", "sentiment_turns", "map_feed_geojson",
]


def main() -> None:
    from pyspark.sql import functions as F

    from postlens.plans.standins import QUERIES
    from postlens.session import get_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", app="postlens-bench", shuffle_partitions=max(8, cpus * 2),
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                               "spark.checkpoint.dir": "file://" + tempfile.mkdtemp(prefix="postlens-bench-")})
    # warm-up on the smallest tables: JVM, code generation
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    spark.read.parquet(f"{sf_dir}/nation.parquet").agg(F.count(F.lit(1))).collect()
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    if os.path.isdir(warm_dir):
        for name in HEADLINE:
            try:
                QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
            except Exception as e:  # noqa: BLE001 - reported below, the timed run goes on
                errors[f"{name} (warm-up)"] = f"{type(e).__name__}: {str(e)[:200]}"
    for name in HEADLINE:
        fn = QUERIES[name]
        t0 = time.perf_counter()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - report and go on
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    total = round(sum(v for v in times.values() if v is not None), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {"metric": "headline_jobs_total", "value": total, "unit": "sec", "queries": times,
           "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf, "cpus": cpus}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
