"""Physical plans: what reaches the scan, what is shuffled, what must not appear."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tidemark.catalog import all_queries
from tidemark.catalog.feeds import FEED, shipments, SHIPMENTS, staged
from tidemark.operators import merge, ranking, windows
from tidemark.session import scratch_path
from tidemark.sinks.landing import write_parquet
from tidemark.sources import tables

QUERIES, _ = all_queries()
# Loads only read their result back, so their own plans say nothing.
LOADS = {"page_load", "load_rejects", "recover_all", "shipment_load", "mart_load", "mart_backfill", "chain_backfill", "chain_backfill_batches", "raw_load", "staging_load", "daily_load", "stream_load", "stream_late_rows", "replay_idempotent", "batch_publish"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LOADS))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text)
    assert not re.search("EvalPython|MapInPandas|FlatMapGroups|PythonUDF", text)


def test_window_bounds_reach_the_scan(spark):
    from datetime import UTC, datetime

    path = scratch_path(spark, "bounds")
    write_parquet(staged(spark, SF_DIR).select("code", "product_name", "last_modified_t"), path)
    rows = windows.window_filter(
        spark.read.parquet(path), "last_modified_t", datetime(2024, 1, 5, tzinfo=UTC), datetime(2024, 1, 6, tzinfo=UTC)
    ).select("code")
    text = plan(rows)
    assert "GreaterThanOrEqual(last_modified_t,1704412800)" in text
    assert "LessThan(last_modified_t,1704499200)" in text
    assert "product_name" not in text[text.index("ReadSchema"):]


def test_staging_scan_reads_one_partition(spark):
    from datetime import date

    path = scratch_path(spark, "partitions")
    write_parquet(staged(spark, SF_DIR).select("code", "batch_date"), path, ["batch_date"])
    text = plan(tables.staging_batch(spark.read.parquet(path), date(2024, 1, 16)))
    assert re.search(r"PartitionFilters: \[.*batch_date.*19738", text) or "2024-01-16" in text
    assert "PushedFilters: []" in text


def test_fact_range_reaches_the_scan(spark):
    path = scratch_path(spark, "facts")
    spark.createDataFrame([(1, 10)], "product_key bigint, source_last_modified_t bigint").write.parquet(path)
    events = spark.createDataFrame([(1, 11)], "product_key bigint, last_modified_t bigint").withColumn(
        "batch_date", F.current_date()
    )
    text = plan(merge.new_facts(events, spark.read.parquet(path), FEED, (5, 50)))
    assert "GreaterThanOrEqual(source_last_modified_t,5)" in text


def test_latest_combines_before_its_one_shuffle(spark):
    text = plan(ranking.latest_per_key(shipments(spark, SF_DIR), SHIPMENTS))
    assert text.count("Exchange ") == 1
    assert "partial_max_by" in text[text.index("Exchange "):]


def test_distinct_events_shuffle_once_and_prune(spark):
    text = plan(merge.distinct_events(shipments(spark, SF_DIR), SHIPMENTS))
    assert text.count("Exchange ") == 1
    schema = text[text.index("ReadSchema"):]
    assert "l_partkey" in schema and "l_extendedprice" not in schema
