"""Time every registered query on one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and fully executed (``noop`` sink: every row produced,
nothing collected to the driver); one warm-up, then the median of
``BENCH_RUNS`` runs. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marquee.plans import registry  # noqa: E402
from marquee.session import build_session  # noqa: E402


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    spark.catalog.clearCache()  # nothing a run kept helps the next one
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus * 2))
    spark = build_session(
        master=f"local[{cpus}]", app_name="marquee-bench", shuffle_partitions=partitions,
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="marquee-bench-")},
    )
    names = only or list(registry.QUERIES)
    timings, errors = {}, {}
    for name in names:
        fn = registry.QUERIES[name]
        try:
            run_once(spark, fn, sf_dir)  # warm-up: JIT, file listing, metadata
            timings[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(runs)), 4)
        except Exception as exc:  # keep timing the others; report the failure
            timings[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:300]}"
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    result = {
        "metric": "total_query_sec",
        "value": round(sum(v for v in timings.values() if v is not None), 4),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }
    if errors:
        result["errors"] = errors
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
