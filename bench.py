"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query after one warm-up (default 1, median kept)
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from ledgerwave.plans.catalog import QUERIES
from ledgerwave.session import local_session

HEADLINE = [
    "income_statement", "balance_assets", "cash_flow_quarterly", "account_coverage",
    "last_quarter", "income_features", "price_period_end", "price_features_1",
    "price_features_2", "features_long_entities", "dedupe_running_count", "label_slug",
    "fundamentals_quarterly",
]


def exchanges(df) -> int:
    """Shuffles in the plan as submitted."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"(?m)^[\s:+*()0-9-]*Exchange ", plan))


def timed(spark, name: str, folder: str) -> tuple[float, int]:
    begin = time.perf_counter()
    df = QUERIES[name](spark, folder)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin, exchanges(df)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    seconds, shuffles = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        timed(spark, name, folder)
        results = [timed(spark, name, folder) for _ in range(runs)]
        seconds[name] = round(statistics.median(r[0] for r in results), 3)
        shuffles[name] = results[-1][1]
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "exchanges": shuffles, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
