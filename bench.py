"""Times every registered query; prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default 4), ``BENCH_RUNS`` (default 1 timed
run after one warm-up; the median of several counts) and ``BENCH_QUERIES`` (comma-separated names).
The result is consumed whole by a write to the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from clipsift.plans.catalog import catalog
from clipsift.session import build_session


def run_once(spark, plan, sf_dir: str) -> float:
    start = time.perf_counter()
    plan(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times, failed = {}, {}
    for name, q in catalog().items():
        if chosen and name not in chosen:
            continue
        try:
            run_once(spark, q.plan, sf_dir)
            times[name] = round(statistics.median(run_once(spark, q.plan, sf_dir) for _ in range(runs)), 3)
        except Exception as err:
            failed[name] = f"{type(err).__name__}: {str(err)[:200]}"
        print(name, times.get(name, failed.get(name)), file=sys.stderr, flush=True)
    spark.stop()
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
    }
    if failed:
        line["failed"] = failed
    print(json.dumps(line))


if __name__ == "__main__":
    main()
