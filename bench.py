"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 3; the median is reported), BENCH_GBT_REPEATS
(default 1: 100 boosting rounds take minutes). Each run builds the query
(including its written intermediates) and executes the whole plan with the
``noop`` sink, so nothing is collected to the driver. A warm-up run of the
cleaning pipeline comes first so JVM start-up is not counted.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillcast.session import drop_materialized, get_session  # noqa: E402

HEADLINE = ("transaction_master", "daily_top_items", "capped_daily", "arima_forecast", "gbt_predict")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    gbt_repeats = int(os.environ.get("BENCH_GBT_REPEATS", "1"))
    spark = get_session(f"local[{cpus}]", app_name="tillcast-bench", shuffle_partitions=cpus * 2)
    spark.sparkContext.setLogLevel("ERROR")

    from tillcast.plans import registry
    from tillcast.sources.files import counted

    def run(name: str) -> tuple[float, int]:
        t0 = time.perf_counter()
        df, obs = counted(registry.QUERIES[name](spark, sf_dir), name)
        df.write.format("noop").mode("overwrite").save()
        elapsed = time.perf_counter() - t0
        drop_materialized(spark)  # keep the checkpoint folder from growing across runs
        return elapsed, obs.get["rows"]

    run("transaction_master")  # warm-up
    timings: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in HEADLINE:
        n = gbt_repeats if name == "gbt_predict" else repeats
        runs = [run(name) for _ in range(n)]
        timings[name] = round(statistics.median(r[0] for r in runs), 3)
        rows[name] = runs[-1][1]
    horizon = registry._horizon()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total_median",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "rows": rows,
        "arima_series_per_sec": round(rows["arima_forecast"] / horizon / timings["arima_forecast"], 2),
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "repeats": {n: (gbt_repeats if n == "gbt_predict" else repeats) for n in HEADLINE},
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
