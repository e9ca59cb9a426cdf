"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then three times; its time is the median. The
result is written to a no-op sink, so the whole plan runs and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tidemark.catalog import all_queries
from tidemark.session import local_session

HEADLINE = (
    "window_filter",
    "window_assign",
    "conform_schema",
    "latest_per_key",
    "distinct_events",
    "scd1_merge",
    "fact_insert_new",
    "mart_reconcile",
    "raw_gate",
    "paginate",
    "surrogate_keys",
    "unique_violations",
    "fk_orphans",
    "extraction_windows",
    "watermark_advance",
    "committed_objects",
    "raw_landing",
    "staging_replace",
    "backfill_dim",
    "backfill_fact",
    "shipment_latest_per_key",
    "shipment_backfill_dim",
    "shipment_backfill_fact",
    "shipment_reconcile",
    "mart_load",
    "mart_backfill",
)
RUNS = 3


def timed(query, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = all_queries()
    times = {}
    for name in wanted:
        timed(queries[name], spark, sf_dir)
        times[name] = round(statistics.median(timed(queries[name], spark, sf_dir) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
