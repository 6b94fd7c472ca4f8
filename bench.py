"""Benchmark: run the queries on $BENCH_SF_DIR and print one JSON line.

Every query of the lakehouse catalog (or those named as arguments) is executed
to completion with a ``noop`` write (the whole plan runs, nothing is collected
to the driver), ``BENCH_REPS`` times (default 3); the median counts, so the
first run serves as warm-up. Single runs on a shared machine vary by ±50 %.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
    python bench.py --reference-settings   # broadcast joins off, 200 shuffle partitions
    python bench.py --event-log=/tmp/run-x  # also write Spark's event log there
                                            # (summarise with tools/stage_times.py)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cdclake.plans.catalog import QUERIES  # noqa: E402
from cdclake.session import build_session  # noqa: E402

def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    reference = "--reference-settings" in sys.argv
    names = [a for a in sys.argv[1:] if not a.startswith("--")] or list(QUERIES)
    conf = {"spark.driver.memory": "16g"}
    for arg in sys.argv[1:]:
        if arg.startswith("--event-log="):
            conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": arg.split("=", 1)[1],
                         "spark.eventLog.compress": "false"})
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 2 * cpus))
    if reference:
        conf.update({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
        parts = 200
    spark = build_session(f"local[{cpus}]", app_name="cdclake-bench", shuffle_partitions=parts, conf=conf)

    def run(name: str) -> float:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    timings: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in names:
        try:
            timings[name] = round(statistics.median(run(name) for _ in range(reps)), 3)
        except Exception as exc:  # one failing query must not cost the whole report
            timings[name] = None
            errors[name] = str(exc).splitlines()[0][:300]
    sf = sf_dir.rsplit("sf", 1)[-1]
    report = {
        "metric": "total_query_seconds" + ("_reference_settings" if reference else ""),
        "value": round(sum(t for t in timings.values() if t is not None), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }
    if errors:
        report["errors"] = errors
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
