"""The chain for many dates at once, and the facts that a load opens."""

from __future__ import annotations

import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_loads import SOURCE, START, dims, end, facts, hour, product, records, staged_rows, watermark
from tests.test_plans import plan
from tidemark.errors import GateError, WindowError
from tidemark.plans import mart_load
from tidemark.plans.backfill import backfill_chain, backfill_raw, windows_of
from tidemark.plans.daily import load_day
from tidemark.plans.mart_load import known_facts, merge_batch
from tidemark.plans.raw_load import Source, marker_location
from tidemark.plans.staging_load import reload_staging
from tidemark.session import scratch_path
from tidemark.sinks import files
from tidemark.sinks.tables import DAY, TableStore, day_of
from tidemark.sources import commits
from tidemark.spec import PRODUCTS, FeedSpec


@pytest.fixture
def roots(spark):
    return scratch_path(spark, "test-raw"), scratch_path(spark, "test-raw")


@pytest.fixture
def other(spark):
    tables = TableStore(spark, scratch_path(spark, "test-store"))
    tables.bootstrap()
    return tables


@pytest.fixture
def feed(spark):
    """Late rows, ties across days, a code on every day, days without rows, a row without a time."""
    rows = [product("every", hour(d, 5), f"e{d}") for d in (0, 1, 2, 5)]
    rows += [product("tie", hour(1, 20), "tie"), product("late", hour(0, 19), "l0"), product("late", hour(2, 1), "l2")]
    rows += [product("b", hour(0, 2), "b0"), product("c", hour(5, 23), "c5"), product("none", None), product("far", hour(30, 0))]
    return records(spark, *rows)


def state(store):
    coded = store.read("fact").join(store.read("dimension").select("code", "product_key"), "product_key")
    return {
        "dimension": sorted((c, n) for c, (n, _) in dims(store).items()),
        "facts": sorted((r.code, r.source_last_modified_t, str(r.batch_date)) for r in coded.collect()),
        "staging": sorted((r.code, r.last_modified_t, str(r.batch_date)) for r in store.read("staging").collect()),
        "metrics": sorted((r.pipeline_layer, str(r.batch_date), r.metric_name, r.metric_value, r.passed) for r in store.read("dq_metrics").collect()),
        "watermark": watermark(store),
        "slots": {t: sorted(k) for t, k in store.snapshot().slots.items() if t in ("staging", "fact")},
    }


DAYS = [end(d) for d in (1, 2, 3, 4, 6)]


@pytest.mark.parametrize("cut", [0, 2])
def test_equals_daily_loads(spark, store, other, roots, feed, cut):
    for day in DAYS:
        load_day(store, roots[0], SOURCE, day, feed)
    for day in DAYS[:cut]:
        load_day(other, roots[1], SOURCE, day, feed)
    done = backfill_chain(other, roots[1], SOURCE, DAYS[cut:][::-1], feed)
    assert state(other) == state(store)
    assert [r.logical_date for r in done.runs] == [d.date() for d in DAYS[cut:]] and all(r.committed for r in done.runs)
    assert {r.logical_date: r.rows for r in done.runs} == done.staged_rows
    for name in ("scan_markers", "scan_manifests"):
        docs = [
            sorted((r.logical_date, r.row_count, r.object_count) for r in getattr(commits, name)(spark, root, "src").where("object_count > 0").collect())
            for root in roots
        ]
        assert docs[0] == docs[1]
    again = backfill_chain(other, roots[1], SOURCE, DAYS, feed)
    assert (again.mart.dimension_changed, again.mart.facts_inserted) == (0, 0)
    assert not any(r.committed for r in again.runs) and state(other) == state(store)


def test_a_null_key_commits_no_date(store, roots, feed):
    bad = feed.unionByName(feed.where("code = 'late'").withColumn("code", F.lit(None).cast("string")))
    with pytest.raises(GateError, match="null keys in the batch of 2026-08-02"):
        backfill_raw(store, roots[0], SOURCE, DAYS, bad)
    assert watermark(store) is None
    assert not any(files.exists(store.spark, marker_location(roots[0], "src", d.date())) for d in DAYS)


def test_a_crash_between_commits_is_healed(store, other, roots, feed, monkeypatch):
    real, made = files.create_json, []

    def crash(spark, location, payload):
        if location.endswith("success.json"):
            if len(made) == 2:
                raise RuntimeError("crash")
            made.append(location)
        return real(spark, location, payload)

    monkeypatch.setattr(files, "create_json", crash)
    with pytest.raises(RuntimeError):
        backfill_raw(store, roots[0], SOURCE, DAYS, feed)
    assert watermark(store) is None
    monkeypatch.undo()
    backfill_chain(store, roots[0], SOURCE, DAYS, feed)
    backfill_chain(other, roots[1], SOURCE, DAYS, feed)
    assert state(store) == state(other)


def test_windows_follow_each_other(store):
    rows = windows_of(store, SOURCE, DAYS[:3]).orderBy("extract_date").collect()
    assert [r.error for r in rows] == [None] * 3
    assert [int(r.extract_start.timestamp()) for r in rows] == [int(t.timestamp()) for t in (START, end(1) - timedelta(hours=6), end(2) - timedelta(hours=6))]


def test_old_dates_and_no_dates(store, roots, feed):
    assert backfill_raw(store, roots[0], SOURCE, [], feed) == []
    load_day(store, roots[0], SOURCE, end(3), feed)
    with pytest.raises(WindowError, match="2026-08-02: batch_end must be later"):
        backfill_raw(store, roots[0], SOURCE, [end(1), end(5)], feed)
    assert reload_staging(store, roots[0], SOURCE, []) == {}


def test_rows_without_a_time_follow_the_rule_of_daily_merges(spark, store, other):
    day = lambda n, *rows: staged_rows(spark, [(0, r) for r in rows]).withColumn("batch_date", F.lit(end(n).date()))
    first = day(1, product("timed", hour(0, 1), "t1"), product("null", None, "n1"), product("both", None, "b1"))
    later = [
        day(2, product("timed", None, "t2"), product("null", None, "n2"), product("both", hour(0, 3), "b2")),
        day(3, product("timed", hour(0, 1), "t3"), product("null", None, "n3"), product("both", None, "b3"), product("new", None, "x3")),
    ]
    for tables in (store, other):
        merge_batch(tables, first, "src/1", PRODUCTS, "src")
    for n, rows in enumerate(later):
        merge_batch(store, rows, f"src/{n + 2}", PRODUCTS, "src")
    merge_batch(other, later[0].unionByName(later[1]), None, PRODUCTS, "src")
    named = lambda s: {c: n for c, (n, _) in dims(s).items()}
    assert named(store) == named(other) == {"timed": "t1", "null": "n3", "both": "b2", "new": "x3"}
    key = lambda s: sorted((c, t) for c, (_, k) in dims(s).items() for p, t, _ in facts(s) if p == k)
    assert key(store) == key(other)


# --- facts by event day ---------------------------------------------------------------


def test_only_days_of_the_batch_are_opened(spark, store, monkeypatch):
    rows = [(0, product(f"c{d}", hour(d, 1))) for d in range(100)]
    merge_batch(store, staged_rows(spark, rows), "src/all", PRODUCTS, "src")
    base = store.snapshot()
    batch = staged_rows(spark, [(0, product("c3", hour(3, 1))), (0, product("c90", hour(90, 1)))])
    between = tuple(batch.agg(F.min("last_modified_t"), F.max("last_modified_t")).first())
    known = known_facts(store, base, PRODUCTS, between, mart_load.event_days(batch, PRODUCTS))
    text = plan(known)
    assert re.search(r"PartitionFilters: \[.*event_day.*dynamicpruning", text)
    assert "source_last_modified_t,17" in text[text.index("PushedFilters"):]
    assert len(known.collect()) == 2
    scans = [n for n in _nodes(known._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan parquet") and "source_last_modified_t" in n.toString()]
    assert [int(n.metrics().apply("numFiles").value()) for n in scans] == [2]
    # The bounds alone, and no bounds at all.
    assert known_facts(store, base, PRODUCTS, between, None).count() == 88
    assert known_facts(store, base, PRODUCTS, None, None).count() == 100
    monkeypatch.setattr(mart_load, "DAYS_MOST", 1)
    assert known_facts(store, base, PRODUCTS, between, mart_load.event_days(batch, PRODUCTS)).count() == 88
    assert merge_batch(store, batch, "src/again", PRODUCTS, "src").facts_inserted == 0


def _nodes(node):
    if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return _nodes(node.executedPlan())
    if node.getClass().getSimpleName().endswith("QueryStageExec"):
        return _nodes(node.plan())
    children = node.children()
    return [node, *[x for i in range(children.size()) for x in _nodes(children.apply(i))]]


def test_days_of_any_second(spark):
    rows = spark.createDataFrame([(-1,), (0,), (86399,), (86400,), (1 << 52,)], "t bigint")
    assert [r[0] for r in rows.select(day_of("t")).collect()] == [-1, 0, 0, 1, (1 << 52) // 86400]
    assert [r[0] for r in rows.select(day_of("t", 7)).collect()][:4] == [-7, 0, 0, 0]


def test_a_feed_of_its_own_with_wide_partitions(spark):
    spec = FeedSpec("part", "t", ("price",), surrogate="part_key", fact_key="sale_key", fact_days=50)
    raw = T.StructType([T.StructField("part", T.LongType(), False), T.StructField("t", T.LongType()), T.StructField("price", T.DoubleType())])
    tables = TableStore(spark, scratch_path(spark, "test-store"), spec, raw)
    tables.bootstrap()
    rows = spark.createDataFrame([(p, int(hour(d, 1).timestamp()), float(d)) for p in (1, 2) for d in range(0, 100, 10)], raw)
    source, root = Source("sales", START, spec=spec, schema=raw), scratch_path(spark, "test-raw")
    done = load_day(tables, root, source, end(60), rows)
    assert (done.raw.rows, done.mart.dimension_changed, done.mart.facts_inserted) == (12, 2, 12)
    done = load_day(tables, root, source, end(100), rows)
    assert (done.raw.rows, done.mart.dimension_changed, done.mart.facts_inserted) == (8, 2, 8)
    assert {(r.part, r.part_key, r.price, r.source_t) for r in tables.read("dimension").collect()} == {(p, p, 90.0, int(hour(90, 1).timestamp())) for p in (1, 2)}
    facts_ = tables.read("fact", with_day=True)
    assert facts_.columns == ["sale_key", "part_key", "source_t", "batch_date", "loaded_at", DAY]
    assert facts_.count() == 20 and facts_.select(DAY).distinct().count() == 3
    again = backfill_chain(tables, root, source, [end(60), end(100)], rows)
    assert (again.mart.dimension_changed, again.mart.facts_inserted) == (0, 0)


def test_facts_keep_their_columns(spark, store):
    merge_batch(store, staged_rows(spark, [(0, product("a", hour(0, 1))), (0, product("a", hour(4, 1)))]), "src/1", PRODUCTS, "src")
    assert store.read("fact").columns == store.schemas["fact"].fieldNames()
    assert store.read("fact", with_day=True).select(DAY).distinct().count() == 2
    assert store.read("staging", with_day=True).columns == store.schemas["staging"].fieldNames()
