from __future__ import annotations

import json
import uuid
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan
from tidemark.catalog import all_queries
from tidemark.errors import GateError, PublishConflict, SchemaError, TidemarkError, WindowError
from tidemark.functions.times import epoch_of
from tidemark.plans import raw_load
from tidemark.plans.daily import backfill_mart, load_day
from tidemark.plans.mart_load import load_mart, merge_batch
from tidemark.plans.page_load import page_reader, parse_pages, stop_of
from tidemark.plans.raw_load import Source, load_raw, marker_location
from tidemark.plans.staging_load import load_staging
from tidemark.schema import RAW, RAW_COLUMNS, relaxed
from tidemark.session import scratch_path
from tidemark.sinks import files, landing, staging
from tidemark.sources import commits
from tidemark.sources.pages import page_items, read_pages
from tidemark.spec import PRODUCTS
from tidemark.streaming.mart_stream import APPLIED, drop_rereads, read_staged, start_mart_stream

START = datetime(2026, 8, 1, tzinfo=UTC)
SOURCE = Source("src", START, timedelta(hours=6))


def end(day: int) -> datetime:
    return START + timedelta(days=day)


def product(code, when: datetime | None, name="n"):
    return (code, name, "b", "a", ["x", None], epoch_of(when) if when else None)


def records(spark, *rows):
    return spark.createDataFrame(list(rows), relaxed(RAW))


def hour(day, h):
    return START + timedelta(days=day, hours=h)


@pytest.fixture
def root(spark):
    return scratch_path(spark, "test-raw")


@pytest.fixture
def feed(spark):
    return records(
        spark,
        product("a", hour(0, 1), "a1"), product("b", hour(0, 5), "b1"), product("a", hour(0, 20), "a2"),
        product("a", hour(1, 3), "a3"), product("c", hour(1, 23), "c1"), product("d", None, "d1"),
        product("late", hour(5, 0), "l1"),
    )


def watermark(store):
    rows = {r.source_name: r.watermark_ts.astimezone(UTC) for r in store.read("watermarks").collect()}
    return rows.get("src")


def dims(store):
    return {r.code: (r.product_name, r.product_key) for r in store.read("dimension").collect()}


def facts(store):
    return sorted((r.product_key, r.source_last_modified_t, str(r.batch_date)) for r in store.read("fact").collect())


def test_two_days(store, root, feed):
    first = load_day(store, root, SOURCE, end(1) + timedelta(hours=13), feed)
    assert (first.raw.rows, first.raw.committed, first.staged_rows) == (3, True, 3)
    assert (first.mart.dimension_changed, first.mart.facts_inserted) == (2, 3)
    assert watermark(store) == end(1)
    second = load_day(store, root, SOURCE, end(2), feed)
    # The lookback re-reads a2, which is neither an update nor a new fact.
    assert (second.raw.rows, second.mart.dimension_changed, second.mart.facts_inserted) == (3, 2, 2)
    assert dims(store) == {"a": ("a3", 1), "b": ("b1", 2), "c": ("c1", 3)}
    assert len(facts(store)) == len(set(f[:2] for f in facts(store))) == 5
    assert {f[2] for f in facts(store)} == {"2026-08-02", "2026-08-03"}
    assert store.read("staging", ["src/2026-08-03"]).count() == 3
    keys = [r.product_update_key for r in store.read("fact").collect()]
    assert len(set(keys)) == 5 and min(keys) >= 1
    metrics = {(r.pipeline_layer, str(r.batch_date), r.metric_name): r for r in store.read("dq_metrics").collect()}
    assert len(metrics) == 8 and all(m.passed for m in metrics.values())


def test_sources_load_the_same_date(store, root, feed):
    other = Source("other", START)
    load_day(store, root, SOURCE, end(1), feed)
    done = load_day(store, root, other, end(1), feed.withColumn("product_name", F.lit("o")))
    assert (done.raw.rows, done.staged_rows) == (3, 3)
    # The same versions again, from another source: nothing is newer, no event is new.
    assert (done.mart.dimension_changed, done.mart.facts_inserted) == (0, 0)
    third = load_day(store, root, Source("third", START), end(1), records(store.spark, product("z", hour(0, 2)), product("a", hour(0, 22), "z2")))
    assert (third.mart.dimension_changed, third.mart.facts_inserted) == (2, 2)
    assert set(store.snapshot().slots["staging"]) == {f"{name}/2026-08-02" for name in ("src", "other", "third")}
    keys = [(r.source_name, r.pipeline_layer, r.batch_date, r.metric_name) for r in store.read("dq_metrics").collect()]
    assert len(keys) == len(set(keys)) == 12


def test_a_failing_source_leaves_the_others_alone(spark, store, root, feed):
    load_day(store, root, SOURCE, end(1), feed)
    before = dims(store), facts(store)
    with pytest.raises(GateError):
        load_day(store, root, Source("bad", START), end(1), records(spark, product(None, hour(0, 1))))
    assert (dims(store), facts(store)) == before
    load_day(store, root, Source("bad", START), end(1), records(spark, product("q", hour(0, 1))))
    assert set(dims(store)) == {"a", "b", "q"}


@pytest.mark.parametrize("change", ["code", "categories_tags_en", "last_modified_t"])
def test_a_table_of_other_types_is_not_committed(spark, store, root, feed, change):
    kinds = {"code": F.lit(7), "categories_tags_en": F.lit("text"), "last_modified_t": F.lit("2026-08-01")}
    with pytest.raises(SchemaError, match=change):
        load_raw(store, root, SOURCE, end(1), feed.withColumn(change, kinds[change]))
    assert not files.exists(spark, marker_location(root, "src", date(2026, 8, 2)))
    assert watermark(store) is None
    wide = feed.withColumn("extra", F.lit(1)).drop("brands")
    assert load_raw(store, root, SOURCE, end(1), wide).committed
    assert load_staging(store, root, SOURCE, date(2026, 8, 2)) == 3


def test_constraints_block_a_mart_load(store, feed, monkeypatch):
    from tidemark.plans import mart_load

    rows = staged_rows(store.spark, [(0, product("a", hour(0, 1))), (0, product("b", hour(0, 2)))])
    before = store.snapshot()
    real = mart_load.merge.merge_type1
    doubled = lambda *a: (lambda m: m.unionByName(m))(real(*a))
    unkeyed = lambda *a: real(*a).withColumn("product_key", F.lit(None).cast("long"))
    for broken, message in ((doubled, "not unique"), (unkeyed, "null in required column")):
        monkeypatch.setattr(mart_load.merge, "merge_type1", broken)
        monkeypatch.setattr(mart_load.quality, "enforce", lambda metrics: metrics.collect())
        with pytest.raises(Exception, match=message):
            merge_batch(store, rows, "x", PRODUCTS, "src")
        assert store.snapshot() == before


def test_loads_leave_no_scratch_behind(spark, store, root, feed):
    from tidemark.session import shared_dir, temporary

    kinds = ("latest-", "placed-", "objects-", "watermarks-", "records-")
    scratch = lambda: {n for n in files.names(spark, shared_dir(spark)) if n.startswith(kinds)}
    before = scratch()
    load_day(store, root, SOURCE, end(1), feed)
    assert scratch() == before
    with pytest.raises(RuntimeError), temporary(spark):
        feed.write.parquet(scratch_path(spark, "latest"))
        assert scratch() != before
        raise RuntimeError
    assert scratch() == before


def test_replay_of_every_layer(store, root, feed):
    load_day(store, root, SOURCE, end(1), feed)
    before = dims(store), facts(store), store.read("staging").count()
    again = load_day(store, root, SOURCE, end(1), feed)
    assert not again.raw.committed and again.raw.rows == 3
    assert (again.mart.dimension_changed, again.mart.facts_inserted) == (0, 0)
    assert (dims(store), facts(store), store.read("staging").count()) == before
    assert store.read("dq_metrics").count() == 4


def test_crash_between_commit_and_advance(store, root, feed, monkeypatch):
    def crash(*_):
        raise RuntimeError("crash")

    monkeypatch.setattr(raw_load, "recover", crash)
    with pytest.raises(RuntimeError):
        load_raw(store, root, SOURCE, end(1), feed)
    assert watermark(store) is None
    monkeypatch.undo()
    empty = feed.limit(0)
    run = load_raw(store, root, SOURCE, end(1), empty)
    assert run.rows == 3 and not run.committed
    assert watermark(store) == end(1)


def test_losing_attempt_adopts_the_winner(spark, store, root, feed, monkeypatch):
    real = files.create_json

    def slower(session, location, payload):
        if location.endswith("_commit/success.json"):
            rival = {**payload, "attempt_id": "rival", "row_count": 99}
            assert real(session, location, rival)
        return real(session, location, payload)

    monkeypatch.setattr(files, "create_json", slower)
    run = load_raw(store, root, SOURCE, end(1), feed)
    assert (run.committed, run.attempt_id, run.rows) == (False, "rival", 99)
    assert watermark(store) == end(1)


def test_losing_attempts_are_invisible(spark, store, root, feed):
    run = load_raw(store, root, SOURCE, end(1), feed)
    loser = raw_load.run_folder(root, "src", run.logical_date) + f"/attempt_id={uuid.uuid4().hex}"
    landing.write_parquet(feed, loser)
    assert load_staging(store, root, SOURCE, run.logical_date) == 3
    assert commits.scan_markers(spark, root, "src").count() == 1


def test_empty_window_commits(store, root, feed):
    run = load_raw(store, root, SOURCE, end(1), feed.filter("code = 'none'"))
    assert (run.rows, run.objects, run.committed) == (0, 0, True)
    assert watermark(store) == end(1)
    assert load_staging(store, root, SOURCE, run.logical_date) == 0
    assert load_mart(store, run.logical_date, PRODUCTS, "src").facts_inserted == 0
    assert sorted((m.metric_value, m.passed) for m in store.read("dq_metrics").collect()) == [(0, True)] * 4


def test_capped_scan_does_not_commit(spark, store, root, feed):
    run = load_raw(store, root, SOURCE, end(1), lambda start, stop: (feed, False))
    assert run.rows == 3 and not run.committed
    assert watermark(store) is None and not files.exists(spark, marker_location(root, "src", run.logical_date))


def test_failed_raw_gate_leaves_nothing(spark, store, root, feed):
    paged = feed.withColumn("page_number", F.lit(1).cast("long"))
    with pytest.raises(GateError, match="Duplicate keys"):
        load_raw(store, root, SOURCE, end(1), paged, page="page_number")
    bad = feed.withColumn("code", F.when(F.col("code") != "b", F.col("code")))
    with pytest.raises(GateError, match="null keys"):
        load_raw(store, root, SOURCE, end(1), bad)
    assert watermark(store) is None
    assert not files.exists(spark, marker_location(root, "src", end(1).date()))
    pages = paged.withColumn("page_number", F.xxhash64("product_name"))
    assert load_raw(store, root, SOURCE, end(1), pages, page="page_number").rows == 3


def test_sources_have_their_own_watermark(store, root, feed):
    other = Source("other", START)
    load_raw(store, root, SOURCE, end(1), feed)
    load_raw(store, root, other, end(2), feed)
    load_raw(store, root, SOURCE, end(3), feed)
    rows = {r.source_name: r.watermark_ts.astimezone(UTC) for r in store.read("watermarks").collect()}
    assert rows == {"src": end(3), "other": end(2)}


def test_older_batch_is_refused(store, root, feed):
    load_raw(store, root, SOURCE, end(3), feed)
    with pytest.raises(WindowError, match="batch_end must be later"):
        load_raw(store, root, SOURCE, end(2), feed)


def test_staging_needs_a_commit(store, root):
    with pytest.raises(TidemarkError, match="no committed run"):
        load_staging(store, root, SOURCE, date(2026, 8, 2))


def test_rows_of_an_unlisted_object_fail_the_staging_gate(store, root, feed):
    load_raw(store, root, SOURCE, end(1), feed)
    base = store.snapshot()
    stale = staging.with_lineage(feed.withColumn("raw_object_key", F.lit("old/part")), date(2026, 8, 2), F.current_timestamp())
    store.publish(base, {"staging": {"src/2026-08-02": [store.write("staging", stale)]}})
    with pytest.raises(GateError, match="row-count mismatch") as failure:
        load_staging(store, root, SOURCE, date(2026, 8, 2))
    assert {m.metric_name: m.passed for m in failure.value.metrics} == {"row_count": False, "null_code_count": True}
    assert store.read("staging").count() == 7 and store.read("dq_metrics").count() == 0


def test_one_batch_is_staged_without_a_sort_by_folder(spark, store, root, feed):
    load_raw(store, root, SOURCE, end(1), feed)
    inserted = load_staging(store, root, SOURCE, end(1).date())
    (folders,) = store.snapshot().slots["staging"].values()
    assert all("_part=" not in f for f in folders) and store.read("staging").count() == inserted > 0


def test_large_dimension_leaves_the_settings_as_they_were(spark, store):
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(name)
    rows = staged_rows(spark, [(0, product("a", hour(0, 1))), (0, product("a", hour(0, 2))), (0, product("b", hour(0, 1)))])
    for _ in range(2):
        merge_batch(store, rows, "one", PRODUCTS, "src", hot_rows=1, broadcast_rows=0)
    assert len(facts(store)) == 3 and spark.conf.get(name) == before


def test_listed_but_empty_object_disappears(spark):
    rows = [(date(2026, 8, 2), k, c) for k, c in [("k1", "a"), ("k2", "b"), ("k3", "c")]]
    frame = spark.createDataFrame(rows, "batch_date date, raw_object_key string, code string")
    fresh = frame.filter("raw_object_key = 'k1'").withColumn("code", F.lit("new"))
    got = staging.replace_objects(frame, fresh, frame.filter("raw_object_key <> 'k3'"))
    assert sorted((r.raw_object_key, r.code) for r in got.collect()) == [("k1", "new"), ("k3", "c")]


def staged_rows(spark, rows):
    frame = records(spark, *[r for _, r in rows]).withColumn(
        "batch_date", F.lit(date(2026, 8, 2))
    ).withColumn("raw_object_key", F.lit("k"))
    return frame.withColumn("loaded_at", F.current_timestamp())


def test_failed_mart_gate_publishes_nothing(spark, store, feed, monkeypatch):
    from tidemark.plans import mart_load

    staged = staged_rows(spark, [(0, product("a", hour(0, 1))), (0, product("b", hour(0, 2)))])
    monkeypatch.setattr(mart_load.merge, "lookup_surrogates", lambda events, dim, *_: events.join(dim, "code").filter("code <> 'b'"))
    before = store.snapshot()
    with pytest.raises(GateError, match="Mart fact reconciliation failed: 1"):
        merge_batch(store, staged, "x", PRODUCTS, "src")
    assert store.snapshot() == before and store.read("dimension").count() == 0


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_hot_code_in_the_mart(spark, store, broadcast_rows):
    rows = [(0, product("hot", hour(0, 0) + timedelta(seconds=i), f"n{i}")) for i in range(120)]
    rows += [(0, product(f"c{i}", hour(0, 1))) for i in range(40)]
    done = merge_batch(store, staged_rows(spark, rows), "x", PRODUCTS, "src", hot_rows=10, broadcast_rows=broadcast_rows)
    assert (done.dimension_changed, done.facts_inserted) == (41, 160)
    assert dims(store)["hot"][0] == "n119"


def test_backfill_equals_daily_loads(spark, store, root, feed):
    for day in (1, 2, 6):
        load_day(store, root, SOURCE, end(day), feed)
    from tidemark.sinks.tables import TableStore

    other = TableStore(spark, scratch_path(spark, "test-store"))
    other.bootstrap()
    backfill_mart(other, store.read("staging"), PRODUCTS, "src")
    named = lambda s: sorted((c, n) for c, (n, _) in dims(s).items())
    assert named(other) == named(store)
    coded = lambda s: sorted(
        (r.code, r.source_last_modified_t, r.batch_date)
        for r in s.read("fact").join(s.read("dimension").select("code", "product_key"), "product_key").collect()
    )
    assert coded(other) == coded(store)
    again = backfill_mart(other, store.read("staging"), PRODUCTS, "src")
    assert (again.dimension_changed, again.facts_inserted) == (0, 0) and coded(other) == coded(store)


def test_only_touched_buckets_are_rewritten(spark):
    from tidemark.sinks.tables import TableStore

    store = TableStore(spark, scratch_path(spark, "test-store"))
    store.bootstrap(dimension_buckets=8)
    rows = [(0, product(f"c{i}", hour(0, 1), "old")) for i in range(60)]
    for small, label in ((1000, "a"), (0, "b")):
        merge_batch(store, staged_rows(spark, rows), label, PRODUCTS, "src", broadcast_rows=small)
    before = store.snapshot()
    assert len(before.slots["dimension"]) == 8
    merge_batch(store, staged_rows(spark, [(0, product("c7", hour(0, 2), "new")), (0, product("x", hour(0, 1)))]), "c", PRODUCTS, "src")
    after = store.snapshot()
    changed = [b for b in before.slots["dimension"] if before.slots["dimension"][b] != after.slots["dimension"][b]]
    assert 1 <= len(changed) <= 2
    now = dims(store)
    assert len(now) == 61 and now["c7"][0] == "new" and now["x"][1] == 61
    assert sorted(key for _, key in now.values()) == list(range(1, 62))
    with pytest.raises(PublishConflict, match="highest-key"):
        store.publish(before, {}, {"highest-key:dimension": "99"})


def test_out_of_order_batch_keeps_the_first_fact(spark, store):
    late = staged_rows(spark, [(0, product("a", hour(0, 1)))])
    merge_batch(store, late.withColumn("batch_date", F.lit(date(2026, 8, 9))), "9", PRODUCTS, "src")
    merge_batch(store, late, "2", PRODUCTS, "src")
    assert [f[2] for f in facts(store)] == ["2026-08-09"]


# --- page documents ----------------------------------------------------------------


def documents(spark, *pages):
    folder = scratch_path(spark, "docs")
    lines = [(p if isinstance(p, str) else json.dumps(p),) for p in pages]
    spark.createDataFrame(lines, "value string").write.text(folder)
    return read_pages(spark, folder)


def page(number, *records, count=999):
    products = [
        {"code": code, "product_name": name, "last_modified_t": epoch_of(t) if isinstance(t, datetime) else t}
        for code, t, name in records
    ]
    return {"page": number, "count": count, "products": products}


def test_pages_end_to_end(spark, store, root):
    inside = epoch_of(hour(0, 4)) + 0.5
    docs = documents(
        spark,
        page(1, ("z", hour(3, 0), "future"), ("bad", "7", "text time"), (5, True, "boolean time")),
        page(2, ("a", hour(0, 20), "a1"), ("b", inside, "b1")),
        page(3, ("a", hour(0, 2), "a0"), (7, hour(-1, 0), "bad code outside the window")),
        page(4, ("old", hour(-2, 0), "too old")),
        page(5, ("c", hour(0, 9), "after the stop")),
    )
    reader = page_reader(docs, PRODUCTS)
    done = load_day(store, root, SOURCE, end(1), reader, page="page_number")
    assert (done.raw.rows, done.staged_rows) == (3, 3)
    assert {c: n for c, (n, _) in dims(store).items()} == {"a": "a1", "b": "b1"}
    assert (2, epoch_of(hour(0, 4)), "2026-08-02") in facts(store)
    assert watermark(store) == end(1)
    # Records without a usable time stand next to the attempt, in its commit and as a metric.
    assert done.raw.rejected == 2
    found = spark.read.parquet(f"{root}/src/extract_date=*/run_id=*/attempt_id=*/_rejects")
    assert sorted((r.page_number, r.position, r.code, r.reason, r.source) for r in found.collect()) == [
        (1, 1, "bad", "string", "src"), (1, 2, "5", "boolean", "src"),
    ]
    metric = store.read("dq_metrics").where("pipeline_layer = 'raw'").collect()
    assert [(m.metric_name, m.metric_value, m.passed) for m in metric] == [("rejected_records", 2, True)]
    assert commits.scan_markers(spark, root, "src").first().reject_count == 2
    version = store.snapshot().version
    again = load_raw(store, root, SOURCE, end(1), reader, page="page_number")
    assert (again.rejected, again.committed, store.snapshot().version) == (2, False, version)


def test_pages_are_parsed_once(spark, monkeypatch):
    from tidemark.plans import page_load

    monkeypatch.setattr(page_load, "PAGES_PER_RANGE", 2)
    docs = documents(spark, *[page(n, (f"c{n}", hour(3 - n, 1), "x"), (f"r{n}", "7", "y")) for n in range(1, 8)])
    scan = page_reader(docs, PRODUCTS)(hour(0, 0), hour(2, 0))
    for rows, count in ((scan.rows, 2), (scan.rejects, 3)):
        text = plan(rows)
        # No JSON below the parsed table, and pages after the stop are not opened.
        assert "variant" not in text.lower() and "json" not in text.lower()
        assert "page_range" in text[text.index("PartitionFilters"):].split("]")[0]
        assert rows.count() == count
    assert {r.page_number for r in scan.rows.collect()} == {2, 3}


def test_shape_of_a_page_is_tested_once_per_page(spark):
    docs = documents(spark, page(1, ("a", hour(0, 1), "x"), ("b", hour(0, 1), "y")), page(2))
    text = plan(page_items(docs))
    # Below the step that takes the records apart.
    assert text.index("Generate") < text.index("records_not_a_list")
    assert [(r.page_number, r.position) for r in page_items(docs).orderBy("page_number", "position").collect()] == [(1, 0), (1, 1), (2, None)]


def test_rows_of_a_range_of_pages_meet(spark, monkeypatch):
    from tidemark.plans import page_load

    monkeypatch.setattr(page_load, "PAGES_PER_RANGE", 8)
    docs = documents(spark, *[page(n, (f"c{n}", hour(0, 1), "x")) for n in range(32)]).repartition(16)
    parsed = parse_pages(docs, PRODUCTS)
    # Not one file of every task for every range.
    assert parsed.count() == 32 and len(parsed.inputFiles()) == 4


def test_page_load_query_takes_every_day(spark):
    folder = scratch_path(spark, "events")
    days = [(n, datetime(2024, 1, 1, 5) + timedelta(days=n // 2), 1 + n, "view", 1.0, "{}") for n in range(80)]
    kind = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(days, kind).write.parquet(f"{folder}/events.parquet")
    got = sorted(r.code for r in all_queries()[0]["page_load"](spark, folder).collect())
    assert got == sorted(f"{1 + n}-{n}" for n in range(80) if n % 97 and (1 + n) % 50)


def test_declared_count_ends_the_scan(spark):
    docs = documents(spark, page(1, ("a", hour(0, 1), "x"), count=1), page(2, ("b", hour(0, 1), "y"), count=1))
    stop = stop_of(parse_pages(docs, PRODUCTS), PRODUCTS, START, None)
    assert (stop.stop_page, stop.last_page, stop.reason) == (1, 1, "all_seen")


def test_empty_page_ends_the_scan(spark):
    docs = documents(spark, page(1, ("a", None, "x")), page(2), page(3, ("b", hour(0, 1), "y")))
    stop = stop_of(parse_pages(docs, PRODUCTS), PRODUCTS, START, None)
    assert (stop.stop_page, stop.last_page, stop.reason) == (2, 1, "empty_page")


def test_page_cap_leaves_the_run_open(spark, store, root):
    docs = documents(spark, page(1, ("a", hour(0, 3), "x")), page(2, ("b", hour(0, 2), "y")))
    run = load_raw(store, root, SOURCE, end(1), page_reader(docs, PRODUCTS, max_pages=1), "page_number")
    assert run.rows == 1 and not run.committed and watermark(store) is None
    run = load_raw(store, root, SOURCE, end(1), page_reader(docs, PRODUCTS), "page_number")
    assert run.rows == 2 and run.committed
    with pytest.raises(ValueError, match="max_pages"):
        page_reader(docs, PRODUCTS, max_pages=0)


def test_bad_pages_leave_nothing(spark, store, root):
    for docs, error, message in (
        (documents(spark, page(1, ("a", hour(0, 1), "x")), "[]"), SchemaError, "wrong shape"),
        (documents(spark, page(1, (5, hour(0, 1), "x"))), SchemaError, "do not fit the schema"),
        (documents(spark, page(1, ("a", hour(0, 1), "x"), ("a", hour(0, 2), "y"))), GateError, "Duplicate keys"),
        (documents(spark, page(1, (None, hour(0, 1), "x"))), GateError, "null keys"),
    ):
        with pytest.raises(error, match=message):
            load_raw(store, root, SOURCE, end(1), page_reader(docs, PRODUCTS), "page_number")
    assert watermark(store) is None
    fine = documents(spark, page(1, ("a", hour(0, 2), "x")), page(2, ("a", hour(0, 1), "y")))
    assert load_raw(store, root, SOURCE, end(1), page_reader(fine, PRODUCTS), "page_number").rows == 2


# --- store -------------------------------------------------------------------------


def test_first_run_sees_empty_tables(store):
    assert store.snapshot().version == 1
    for name, schema in store.schemas.items():
        frame = store.read(name)
        assert frame.columns == schema.fieldNames() and frame.count() == 0
    assert store.bootstrap().version == 1


def test_concurrent_publish(spark, store):
    rows = staged_rows(spark, [(0, product("a", hour(0, 1)))])
    base = store.snapshot()
    store.publish(base, {"staging": {"d1": [store.write("staging", rows)]}})
    after = store.publish(base, {"staging": {"d2": [store.write("staging", rows)]}})
    assert after.version == 3 and store.read("staging").count() == 2
    with pytest.raises(PublishConflict):
        store.publish(base, {"staging": {"d1": [store.write("staging", rows)]}})
    assert store.read("staging", snapshot=base).count() == 0


def test_marker_is_created_once(spark, root):
    assert files.create_json(spark, f"{root}/x/m.json", {"a": 1})
    assert not files.create_json(spark, f"{root}/x/m.json", {"a": 2})
    assert files.read_json(spark, f"{root}/x/m.json") == {"a": 1}


def test_landing_is_verified(spark, root, feed):
    written = landing.land_parts(feed, root, "last_modified_t", "code")
    found = landing.inventory(spark, root, root.rsplit("/", 1)[0])
    landing.verify_landing(found, written)
    row = found.first()
    assert written == 7 and row.size_bytes > 0 and row.object_key.startswith("test-raw-")
    with pytest.raises(GateError, match="Landing verification failed"):
        landing.verify_landing(found, written + 1)
    assert spark.read.parquet(root).columns == RAW_COLUMNS


# --- stream ------------------------------------------------------------------------


def test_stream_skips_a_batch_it_has_published(spark, store):
    inbox = scratch_path(spark, "inbox")
    staged_rows(spark, [(0, product("a", hour(0, 1), "first"))]).select(
        *store.schemas["staging"].fieldNames()
    ).write.parquet(inbox)
    for _ in range(2):
        start_mart_stream(
            drop_rereads(read_staged(store, inbox), PRODUCTS, "2 days"), store, PRODUCTS, "src", scratch_path(spark, "cp"), "s"
        ).awaitTermination()
    snapshot = store.snapshot()
    assert snapshot.properties[APPLIED + "s"] == "0"
    assert list(snapshot.slots["fact"]) == ["src/s"]
    assert dims(store) == {"a": ("first", 1)}
    counted = {r.metric_name: r.metric_value for r in store.read("dq_metrics").where("pipeline_layer = 'stream'").collect()}
    assert counted == {"received_rows": 1, "untimed_rows": 0, "late_rows": 0, "new_events": 1, "reread_events": 0}


def test_stream_goes_on_from_its_checkpoint(spark, store):
    inbox, checkpoint = scratch_path(spark, "inbox"), scratch_path(spark, "cp")
    columns = store.schemas["staging"].fieldNames()
    for turn, h in enumerate((1, 2)):
        rows = [(0, product("a", hour(0, h), f"n{turn}")), (0, product(f"x{turn}", hour(0, h)))]
        staged_rows(spark, rows).select(*columns).write.mode("append").parquet(inbox)
        start_mart_stream(read_staged(store, inbox), store, PRODUCTS, "src", checkpoint, "s").awaitTermination()
    assert dims(store)["a"] == ("n1", 1)
    assert len(facts(store)) == 4
    rows = [(0, product("a", hour(0, 1), "known")), (0, product("late", hour(-1, 1))), (0, product("none", None))]
    staged_rows(spark, rows).select(*columns).write.mode("append").parquet(inbox)
    start_mart_stream(read_staged(store, inbox), store, PRODUCTS, "src", checkpoint, "s").awaitTermination()
    counted = {r.metric_name: r.metric_value for r in store.read("dq_metrics").where("pipeline_layer = 'stream'").collect()}
    assert counted == {"received_rows": 7, "untimed_rows": 1, "late_rows": 1, "new_events": 5, "reread_events": 1}


# --- a store that stays small --------------------------------------------------------


def test_folders_and_pointers_of_many_micro_batches_stay_few(spark, store, monkeypatch):
    from tidemark.sinks import tables as sink

    monkeypatch.setattr(sink, "FOLDERS_PER_LEVEL", 3)
    rows = staged_rows(spark, [(0, product("a", hour(0, 1)))])
    for turn in range(20):
        base = store.snapshot()
        folders = [*base.slots["staging"].get("s", []), store.write("staging", rows.withColumn("code", F.lit(str(turn))))]
        store.publish(base, {"staging": {"s": store.joined("staging", folders)}})
        assert len(store.snapshot().slots["staging"]["s"]) <= 2 * 3
        if turn % 5 == 4:
            store.expire(2, timedelta(0))
            assert len(files.names(spark, f"{store.root}/_pointers")) == 2
    assert {r.code for r in store.read("staging").collect()} == {str(t) for t in range(20)}
    assert len(files.names(spark, f"{store.root}/staging")) <= 10
    with pytest.raises(ValueError):
        store.expire(0)


# --- control files -------------------------------------------------------------------


@pytest.mark.parametrize("step", ["_write", "_publish"])
def test_a_crash_leaves_no_torn_control_file(spark, monkeypatch, step):
    folder = scratch_path(spark, "control")
    location = f"{folder}/marker.json"
    real = getattr(files, step)

    def crash(*args):
        if step == "_write":
            args[0].create(args[1], False).close()
        raise RuntimeError("crash")

    monkeypatch.setattr(files, step, crash)
    with pytest.raises(RuntimeError):
        files.create_json(spark, location, {"a": 1})
    assert not files.exists(spark, location)
    monkeypatch.setattr(files, step, real)
    assert files.create_json(spark, location, {"a": 1})
    assert files.read_json(spark, location) == {"a": 1}


def test_the_first_control_file_stays_and_is_whole_when_seen(spark, monkeypatch):
    location = f"{scratch_path(spark, 'control')}/marker.json"
    real, seen = files._write, []

    def slow(fs, path, content):
        real(fs, path, content)
        seen.append(files.exists(spark, location))
        # Another writer is faster.
        if len(seen) == 1:
            assert files.create_json(spark, location, {"a": "rival"})

    monkeypatch.setattr(files, "_write", slow)
    assert not files.create_json(spark, location, {"a": "own"})
    assert seen == [False, False] and files.read_json(spark, location) == {"a": "rival"}
    assert files.names(spark, location.rpartition("/")[0]) == ["marker.json"]
