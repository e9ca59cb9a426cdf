"""Recovery of all sources, and row numbers over sized ranges."""

from __future__ import annotations

from datetime import UTC

import pytest
from pyspark.sql import functions as F

from tests.test_loads import SOURCE, START, end, hour, product, records
from tidemark.operators import ranking
from tidemark.plans import raw_load
from tidemark.plans.raw_load import Source, load_raw, marker_location
from tidemark.plans.recovery import recover_all
from tidemark.session import scratch_path
from tidemark.sinks import files


def marks(store):
    return {r.source_name: r.watermark_ts.astimezone(UTC) for r in store.read("watermarks").collect()}


def test_all_sources_catch_up_at_once(spark, store, monkeypatch):
    root = scratch_path(spark, "test-raw")
    assert recover_all(store, root).advanced == 0
    feed = records(spark, product("a", hour(0, 1)), product("b", hour(1, 1)))
    odd = Source("a=b %20 c", START)
    load_raw(store, root, SOURCE, end(1), feed)
    with monkeypatch.context() as patch:
        patch.setattr(raw_load, "recover", lambda *_: None)
        load_raw(store, root, SOURCE, end(2), feed)
        load_raw(store, root, odd, end(2), feed)
    torn = marker_location(root, "src", end(3).date())
    files.create_json(spark, torn, {"source": "src", "run_id": "r"})
    late = marker_location(root, "other", end(4).date())
    path, fs = files._path(spark, late)
    files._write(fs, path, bytearray(b'{"source": "other", "next_wat'))
    assert marks(store) == {"src": end(1)}
    version = store.snapshot().version
    done = recover_all(store, root)
    assert done.advanced == 2 and done.torn_count == 2
    assert sorted(done.torn) == sorted(t[len(root) + 1 :] for t in (torn, late))
    assert marks(store) == {"src": end(2), odd.name: end(2)}
    assert store.snapshot().version == version + 1
    assert recover_all(store, root).advanced == 0 and store.snapshot().version == version + 1
    # Single loads go on from the slots that were written together.
    assert load_raw(store, root, odd, end(3), feed).committed
    assert marks(store)[odd.name] == end(3)


@pytest.mark.parametrize(("rows", "most"), [(7, 1 << 30), (50, 60), (1 << 30, 30)])
def test_numbers_over_small_ranges(spark, monkeypatch, rows, most):
    monkeypatch.setattr(ranking, "RANGE_ROWS", rows)
    monkeypatch.setattr(ranking, "RANGE_MOST", most)
    frame = spark.range(500).select((F.col("id") * 7919 % 500).alias("k"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("skewed"))
    for order in (["k"], ["skewed", "k"]):
        got = [r.n for r in ranking.with_ordinal(frame, [F.col(c) for c in order], "n").orderBy(*order).collect()]
        assert got == list(range(1, 501))
        placed = ranking._placed(frame, [F.col(c) for c in order])
        assert placed.groupBy("_slice").count().agg(F.max("count")).first()[0] <= most
    total = ranking.running_total(frame, ["skewed"], ["k"], "k", "sum").where("skewed = 1").orderBy("k").collect()
    seen = 0
    for r in total:
        seen += r.k
        assert r["sum"] == seen


def test_equal_rows_beyond_a_range_are_refused(spark, monkeypatch):
    monkeypatch.setattr(ranking, "RANGE_MOST", 5)
    with pytest.raises(ValueError, match="equal in their order"):
        ranking.with_ordinal(spark.range(40).select(F.lit(1).alias("k")), [F.col("k")])


def test_no_rows_have_no_numbers(spark):
    assert ranking.with_ordinal(spark.range(0), [F.col("id")]).count() == 0
