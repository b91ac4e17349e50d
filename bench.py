"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
The load of the stored silver tables is an entry of its own. Each query is fully executed with the no-op sink (every row computed, none
collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "g10_run_daily", "g11_stop_daily", "g13_disruption_daily", "g14_run_monthly",
    "h4_punctuality_monthly", "h7_stop_hourly_monthly", "h1_run_daily_trace", "h9_run_route",
    "d10_operation_header", "d11_operation_details", "e3_run_diff", "e5_disruption_diff",
    "d14_operation_tracking_log", "d15_disruption_tracking_log", "c1_merge_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from perron.queries import REGISTRY
    from perron.session import get_spark
    spark = get_spark(master=f"local[{cpus}]")
    names = [n for n in HEADLINE if n in REGISTRY]
    if len(sys.argv) > 1:
        names = [n for n in REGISTRY if any(a in n for a in sys.argv[1:])]
    # warm-up: JVM, file listing, codegen caches (not timed)
    REGISTRY["f3_d_station"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    # the stored silver tables are made once a session: timed by themselves, not with the first query that reads them
    from perron.plans.silver_model import _FIELDS
    from perron.queries import _silver
    t0 = time.perf_counter()
    for table in _FIELDS:
        getattr(_silver(spark, sf_dir), table)
    times["silver_load"] = round(time.perf_counter() - t0, 3)
    for n in names:
        t0 = time.perf_counter()
        REGISTRY[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
