"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from leafwave.plans import QUERIES  # noqa: E402
from leafwave.session import local_session  # noqa: E402

HEADLINE = [
    "flagship_vod_per_cell",
    "temporal_agg_mean",
    "cell_assign_5deg_count",
    "percell_timeseries",
    "global_average",
    "weighted_timeseries",
    "filter_zscore",
    "percell_iqr",
    "hampel_cell_sid",
    "hampel_sliding",
    "asof_nearest",
    "hermite_interp",
    "clock_interp",
    "dedup_read",
    "audit_diff_stats",
    "rinex3_parse",
    "solar_elevation",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    # Start the JVM and read one table before the clock runs.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
