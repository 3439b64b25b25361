"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3), BENCH_SECONDS (default 420): each
query runs once on the same tables to warm up and then BENCH_RUNS times; the median counts. Once BENCH_SECONDS have
passed, queries get a single run after their warm-up; `runs` says how many each had. Results go to Spark's no-op
sink, so that every row is computed and none is moved to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from tillroll.plans.registry import QUERIES
from tillroll.session import build_session, ensure_checkpoint_dir

HEADLINE = [
    "ingest_audit",
    "dws_basket_item",
    "dws_customer_summary",
    "ads_overview",
    "kpi_monthly",
    "rfm_snapshots",
    "rfm_segment_summary",
    "segment_migrations",
    "association_rules",
    "segment_rules",
    "rule_drift",
    "product_relations",
    "recommendations",
    "synthetic_transactions",
]


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    until = time.perf_counter() + float(os.environ.get("BENCH_SECONDS", "420"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="tillroll-bench-"))

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds, counts = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        once(name)
        times = [once(name)]
        while len(times) < runs and time.perf_counter() < until:
            times.append(once(name))
        seconds[name], counts[name] = round(statistics.median(times), 3), len(times)
        print(name, seconds[name], file=sys.stderr, flush=True)
    result = {
        "metric": "total seconds of the headline queries, median of warm runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "runs": counts,
    }
    print(json.dumps(result))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
