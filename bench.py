"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the table directory, ``BENCH_CPUS`` the number of local cores. Each query
runs once to warm up and then three times; the median counts. Results go to the noop sink, so
every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adlumen.plans.catalog import QUERIES  # noqa: E402
from adlumen.session import build_session  # noqa: E402

HEADLINE = [
    "revenue_by_advertiser", "content_performance", "fraud_summary", "silver_legitimate",
    "silver_quarantine", "dedup_impressions", "validate_impressions", "ingest_stats",
    "dash_summary", "quality_gate", "payment_reconciliation", "engagement_by_content",
    "sink_silver", "stream_bronze_ingest",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in HEADLINE:
        def run() -> float:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

        run()
        timings[name] = round(statistics.median(run() for _ in range(RUNS)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds_of_headline_queries", "value": round(sum(timings.values()), 3),
        "unit": "sec", "queries": timings, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
