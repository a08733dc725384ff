"""Benchmark: headline queries on $BENCH_SF_DIR (default sf0.1) on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (full execution, no
collect to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["diagnose_all", "rate", "increase", "histogram_quantile", "query_range_gauge",
            "query_summary", "payload_matrix", "list_metrics", "series_cap", "outcome_rollup"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from chronolens.session import get_session
    from chronolens.plans.catalog import QUERIES
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus),
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    times: dict[str, float] = {}
    # cold: deriving and writing the samples table that the metric queries read
    from chronolens.sources.testviews import samples_table
    t0 = time.perf_counter()
    samples_table(spark, sf_dir)
    times["build_samples_table"] = round(time.perf_counter() - t0, 3)
    for name in names:
        spark.catalog.clearCache()   # no query reads what another one kept
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
