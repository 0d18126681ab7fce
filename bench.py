"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]
and print one JSON line with wall seconds per query.

Each query is materialised fully (a no-op write of every row), so the whole
plan runs; the first pass warms the JVM and is not counted.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from torqueframe.plans.catalog import QUERIES  # noqa: E402
from torqueframe.session import get_session  # noqa: E402

HEADLINE = ["config_history", "vehicle_scores", "segmentation_flags", "ffill_bfill", "config_summary",
            "minmax_score", "stratified_split", "oversample", "chi2_score", "roc_points",
            "dense_calendar_total", "silhouette_squared", "sort_nulls_last", "symbol_replace", "knn_vote",
            "margin_pct", "unmapped_report", "visit_merge"]


def run(spark, name, d):
    t0 = time.perf_counter()
    QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(cpus * 2, 8),
                        extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    for n in names[:3]:
        run(spark, n, d)  # warm-up
    times = {}
    for n in names:
        times[n] = round(statistics.median(run(spark, n, d) for _ in range(reps)), 3)
    sf = os.path.basename(d.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "median_wall_sec_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "reps": reps}))


if __name__ == "__main__":
    main()
