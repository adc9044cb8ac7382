"""Benchmark the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_RUNS`` (default 3; the median of the warm runs is
reported after one warm-up run).  Each query is timed end to end: plan
construction plus a full execution that writes nothing (``noop`` sink), so
every row is produced.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lakework.plans import catalog  # noqa: E402
from lakework.session import local_session  # noqa: E402

HEADLINE = (
    "invoice_eligibility_line",
    "scope_assignment_current",
    "snapshot_delta",
    "unit_price",
    "eligibility_scope_summary",
    "deliveries_agg",
    "survey_rollup",
    "floc_attributes_dim",
)


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = catalog.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")), app="lakework-bench")
    times: dict[str, float] = {}
    for name in HEADLINE:
        run_once(spark, name, sf_dir)  # warm-up: JIT, file listing, first-touch caches
        samples = [run_once(spark, name, sf_dir) for _ in range(runs)]
        times[name] = round(statistics.median(samples), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
