"""Headline-query timings. Prints ONE JSON line:

{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is executed fully with the ``noop`` sink (no driver collect);
the value is the sum of per-query wall times after one warm-up query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_transactions",
    "customer_360",
    "fact_sales",
    "sales_summary",
    "inventory_snapshot",
    "sessionise",
    "scd2_merge",
    "upsert_orders",
    "dq_silver",
    "rejects_by_reason",
]


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strata-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from strata.session import ensure_checkpoint_dir

    if not spark.conf.get("spark.checkpoint.dir", None):
        ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="strata-bench-ck-"))

    from strata.plans.queries import QUERIES

    names = sys.argv[1:] or HEADLINE
    # warm-up: JVM, codegen caches, parquet footers
    QUERIES["clean_transactions"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
