"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  A query is executed in
full through the ``noop`` sink (every row computed, nothing collected).
Each query runs once untimed first (JVM warm-up: class loading, JIT and
code generation), then twice timed; the best of the two is reported, as
run-to-run noise on a shared host is large.  Every run builds its plan
afresh and nothing is cached between runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tapflow.plans.queries import queries  # noqa: E402
from tapflow.session import get_session  # noqa: E402

TIMED_RUNS = 2
HEADLINE = ["bus_cleaned", "metro_cleaned", "bus_with_site", "metro_with_site", "all_taps",
            "od_records", "passenger_flow", "flow_preview"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = get_session()
    qs = queries()
    for key in HEADLINE:  # warm-up pass, untimed
        run(qs[key](spark, sf_dir))
    times: dict[str, float] = {}
    for _ in range(TIMED_RUNS):
        for key in HEADLINE:
            start = time.perf_counter()
            run(qs[key](spark, sf_dir))
            took = round(time.perf_counter() - start, 3)
            times[key] = min(times.get(key, took), took)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
