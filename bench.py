"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

The driver tables have one row group each, which one task would read; they are first stored again
in as many files as there are cores, as a landed table is, and that is not timed. Each query runs
once to warm up and then ``$BENCH_RUNS`` times; the median counts. Results are written in full to
a sink that discards them, so no column or row is optimized away."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfmark.session import local_session  # noqa: E402
from verification.feeds import TABLES  # noqa: E402
from verification.queries import REGISTRY  # noqa: E402

HEADLINE = {
    "q1": "dedupe_lines",
    "q2": "silver_header",
    "q3": "fact_sales",
    "q4": "store_performance",
    "q5": "agg_daily",
    "q6": "agg_monthly",
    "q7": "agg_product",
    "q8": "fk_existence_flags",
    "q9": "overlap_pairs",
    "q10": "scorecard",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    settings = {"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")}
    spark = local_session(cpus, "bench", **settings)
    # a local session only: its executors share the driver's disk
    stored = tempfile.mkdtemp(prefix="bench-")
    for table in TABLES:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(int(cpus)).write.parquet(f"{stored}/{table}.parquet")
    times: dict[str, float] = {}
    for label, name in HEADLINE.items():
        taken = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            REGISTRY[name](spark, stored).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        times[f"{label}_{name}"] = round(statistics.median(taken[1:]), 3)
    total = round(sum(times.values()), 3)
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()
