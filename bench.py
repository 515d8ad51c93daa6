"""Benchmark the headline queries.

Runs every headline query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]`` and prints one JSON line.  Each query is executed
in full into Spark's ``noop`` sink (the whole plan runs, nothing is collected
to the driver).  One warm-up pass on the smallest data set runs first so JIT
compilation is not billed to the first query.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.harness.queries import registry  # noqa: E402
from strata.session import get_session  # noqa: E402

HEADLINE = [
    "fact_orders", "fact_purchases", "dim_customer", "dim_geography", "dim_people",
    "dim_stock_item", "dim_supplier", "dim_calendar", "silver_orders", "silver_order_lines",
    "silver_csv_roundtrip", "null_policy", "ingest_split", "impute_audit", "layer_overview",
]
# timed beside them, not part of the total (which stays comparable between rounds)
MORE = ["silver_incremental", "publish_rows", "run_fact_orders"]
WARMUP_DIR = "/root/testdata/sf0.001"


def run(spark, q, sf_dir):
    q(spark, sf_dir).write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {"spark.driver.memory": "16g"}
    if os.environ.get("BENCH_EVENT_LOG"):
        # stage/task timings for later inspection, in a fresh scratch folder
        log_dir = tempfile.mkdtemp(prefix="strata-eventlog-")
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
        print(f"event log: {log_dir}", file=sys.stderr)
    spark = get_session(f"local[{cpus}]", app_name="strata-bench", shuffle_partitions=2 * cpus, extra=extra)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-bench-ckpt-"))
    qs = registry()
    if os.path.isdir(WARMUP_DIR) and os.path.abspath(WARMUP_DIR) != os.path.abspath(sf_dir):
        for name in HEADLINE + MORE:
            run(spark, qs[name], WARMUP_DIR)
    times = {}
    for name in HEADLINE + MORE:
        t0 = time.perf_counter()
        run(spark, qs[name], sf_dir)
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times[n] for n in HEADLINE), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
