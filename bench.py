"""Bench: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS] and print one JSON line.

Each query is executed in full through the ``noop`` sink (every row is produced, nothing is collected to
the driver). Warm-up runs a few query shapes on the smallest sibling scale factor first (falling back to
the bench data), so JVM start-up and JIT compilation are not charged to whichever query comes first.
Set BENCH_QUERIES=a,b to run a subset and BENCH_REPEAT=n to keep the best of n runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.registry import QUERIES, VARIANTS  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    spark.sparkContext.setLogLevel("OFF")
    parent = os.path.dirname(sf_dir.rstrip("/"))
    warm_dir = os.path.join(parent, "sf0.001")
    warm_dir = warm_dir if os.path.isdir(warm_dir) else sf_dir
    for name in ("page_view", "hot_items", "channel_total", "tx_match", "login_fail_timed"):
        run(QUERIES[name](spark, warm_dir))
    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if name not in only if only else name in VARIANTS:
            continue
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(fn(spark, sf_dir))
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
