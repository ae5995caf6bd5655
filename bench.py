"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's result is fully computed into Spark's `noop` sink (no collect),
best of $BENCH_REPEAT runs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import platform
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans.registry import QUERIES  # noqa: E402
from strata.session import get_spark  # noqa: E402

# published event layout, typed projection, pipe-text scan); its sum is the
# headline value.
HEADLINE = ("history_merge", "history_merge_dups", "typed_projection", "pipe_csv_scan", "wide_merge")
# Also timed and reported, not summed.
EXTRA = ("full_load", "ragged_rows", "incremental_load", "stored_merge", "multi_feed_run",
         "wide_full_load")


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE + EXTRA)).split(",") if n]
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    # warm-up: one untimed run of each query (JIT, class loading, footers)
    warm = os.environ.get("BENCH_WARMUP", "1") != "0"
    errors = {}

    def run(n):
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()

    if warm:
        for n in names:
            try:
                run(n)
            except Exception as e:  # noqa: BLE001 - reported, not fatal
                errors[n] = f"{type(e).__name__}: {str(e)[:200]}"
    timings = {}
    for n in names:
        if n in errors:
            continue
        best = None
        try:
            for _ in range(repeat):
                t0 = time.perf_counter()
                run(n)
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
        except Exception as e:  # noqa: BLE001
            errors[n] = f"{type(e).__name__}: {str(e)[:200]}"
            continue
        timings[n] = round(best, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "baseline_set_total",
        "value": round(sum(v for k, v in timings.items() if k in HEADLINE), 3), "unit": "sec",
        "queries": timings, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus, "repeat": repeat, "warmup": warm, "python": platform.python_version(),
        "spark": spark.version, **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
