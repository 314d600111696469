"""A feed of the published size (3 million rows) from the given documents, and the job over it.

The one-pass job is against the plan that repeats the input for every action (13 passes).

usage: python tools/scale_check.py <new work folder> [rows] [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from threadsift.plans.job import JobOptions, run_job  # noqa: E402
from workload.scale_feed import PUBLISHED_ROWS, make_feed  # noqa: E402

def timed(label: str, action) -> float:
    start = time.perf_counter()
    action()
    took = time.perf_counter() - start
    print(f"{label}: {took:.1f} s", flush=True)
    return took


def main() -> None:
    work = sys.argv[1]
    rows = int(sys.argv[2]) if len(sys.argv) > 2 else PUBLISHED_ROWS
    sf_dir = sys.argv[3] if len(sys.argv) > 3 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.local.dir", f"{work}/spark")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    feed = f"{work}/feed"
    timed("make feed", lambda: make_feed(spark, sf_dir, feed, rows))

    result = None

    def job() -> None:
        nonlocal result
        result = run_job(spark, feed, f"{work}/job", JobOptions())
        if not result.ok:
            raise result.error

    timed("job, first run", job)
    took = timed("job, second run", job)
    print(json.dumps(result.quality.report()["metrics"], indent=1))
    kept = result.quality.metrics["extraction"]["total_records"]
    print(f"job rate: {kept / took:,.0f} rows/s")


if __name__ == "__main__":
    main()
