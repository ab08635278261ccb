"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8), executing the full plan with the
``noop`` sink (no collect), and prints one JSON line:

    {"metric": "headline_total_sec", "value": N, "unit": "sec",
     "queries": {"name": sec, ...}, "sf": ..., ...}

``land_raw`` is the landing of the whole feed as raw JSON.  The copies that the
other queries read are landed once before timing (``setup_land_sec``).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "stg_watch_events",
    "stg_fork_events",
    "fct_repo_daily",
    "mart_top_watch",
    "mart_top_fork",
    "mart_rising",
    "mart_intent_rates",
    "dq_report",
    "land_raw",
    "raw_roundtrip",
    "extract_range",
    "run_pipeline",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from repotrend.session import get_session
    from repotrend import queries as Q
    from repotrend.session import work_dir
    from repotrend.sources import raw

    spark = get_session(
        master=f"local[{cpus}]",
        app_name="repotrend-bench",
        shuffle_partitions=int(cpus) * 2,
        extra_conf={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                    "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def execute(name: str, folder: str) -> None:
        if name == "land_raw":
            raw.land_raw(Q._lines(spark, folder), work_dir(spark) + "/raw")
        else:
            Q.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    # Fixture landing (raw JSON from the feed; not pipeline work) and one
    # JVM warm-up pass of every query on the smallest data: both untimed.
    t0 = time.perf_counter()
    Q._landed(spark, sf_dir)
    Q._landed(spark, sf_dir, clean=True)
    setup = time.perf_counter() - t0
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    t0 = time.perf_counter()
    if os.path.isdir(warm_dir) and warm_dir.rstrip("/") != sf_dir:
        for name in names:
            execute(name, warm_dir)
    warmup = time.perf_counter() - t0

    times: dict[str, float] = {}
    for name in names:
        t = time.perf_counter()
        execute(name, sf_dir)
        times[name] = round(time.perf_counter() - t, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": int(cpus),
                "setup_land_sec": round(setup, 3),
                "warmup_sec": round(warmup, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
