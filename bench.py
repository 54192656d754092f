"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row is
produced, nothing is collected to the driver).  Prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.
Set BENCH_QUERIES=all to time every registered query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "hierarchy_rollup", "daily_by_account", "monthly_summary", "chargeback_monthly", "fy_to_date",
    "latest_snapshot", "hourly_demand", "seat_utilisation", "grain_reconcile", "star_enrich",
    "capacity_chargeback", "edge_report", "orphan_edges", "seasonal_naive", "accuracy_table",
    "budget_vs_forecast", "cost_anomalies", "changepoints", "wls_reconcile", "department_chargeback",
    "mstl_forecast", "wls_var",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from costweave.plans import registry
    from costweave.session import clean_scratch, get_spark
    registry.load_all()
    spark = get_spark(app="costweave-bench", master=f"local[{cpus}]",
                      shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * int(cpus)))),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    names = list(registry.QUERIES) if os.environ.get("BENCH_QUERIES") == "all" else \
        [n for n in (os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE)
         if n in registry.QUERIES]
    # session warm-up (JVM class loading, codegen caches): one tiny job on a
    # driver table that is not part of any timed query
    spark.read.parquet(os.path.join(sf_dir, "region.parquet")).groupBy().count().collect()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    result = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
              "queries": times}
    if os.environ.get("BENCH_REPEAT") == "2":                      # second (warm) run per query
        warm = {}
        for name in names:
            t0 = time.time()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            warm[name] = round(time.time() - t0, 3)
        result["queries_second_run"] = warm
    m = re.search(r"sf([0-9.]+)", sf_dir)
    result["sf"] = float(m.group(1)) if m else sf_dir
    print(json.dumps(result))
    clean_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
