"""Seconds per headline query on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from veloflow.catalog import QUERIES  # noqa: E402
from veloflow.session import local_session  # noqa: E402

HEADLINE = (
    "dtv_by_counter",
    "dtv_from_lineitem",
    "edge_dedupe",
    "target_stats",
    "nearest_edge",
    "candidate_counts",
    "nearest_centroid",
    "unit_intersects",
    "detect_all",
    "metrics",
    "calib_stratified",
    "calib_loocv",
    "reference_compare",
    "etl_pipeline",
    "predict_pipeline",
    "etl_review",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("OFF")
    # start the JVM's compilers and file listing before the clock
    QUERIES["campaign_filter"](spark, sf).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
        spark.catalog.clearCache()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
