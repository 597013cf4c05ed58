"""Time the headline queries; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Every query first runs once to warm the JVM up (one pass over all of them,
so that the first query timed does not pay for the JIT), then each runs
``BENCH_RUNS`` times into the ``noop`` sink (the whole result is computed,
nothing is collected); the median is reported.  ``value`` is the sum of the
medians.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from signalspark.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "datapoints_per_day",
    "hourly_avg_trunc",
    "hourly_avg_window",
    "signal_rename",
    "indicator_lineitem",
    "json_envelope",
    "mapping_join_fanout",
    "stream_end_to_end",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("signalspark-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="signalspark-bench-"))

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:
        run(name)
    timings = {name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
