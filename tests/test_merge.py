from __future__ import annotations

import random
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.operators.ranking import latest_per_key
from tidemark.spec import FeedSpec

SPEC = FeedSpec("code", "t", ("v",), ("id",))
THEN, NOW = datetime(2026, 1, 1, tzinfo=UTC), datetime(2026, 1, 2, tzinfo=UTC)
DIM = "product_key bigint, code string, v string, source_t bigint, created_at timestamp, updated_at timestamp"
STAGED = "code string, t bigint, v string, id int, batch_date date"


def dimension(spark, rows):
    return spark.createDataFrame([(i + 1, c, v, t, THEN, THEN) for i, (c, v, t) in enumerate(rows)], DIM)


@pytest.fixture(params=["-1", "10m"])
def broadcast(spark, request):
    """Without and with sides small enough to be sent to all tasks."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield request.param
    spark.conf.set(name, kept)


def test_a_null_key_is_an_error_in_a_batch_of_any_size(spark, broadcast):
    latest = spark.createDataFrame([("a", 1, "x"), (None, 1, "y")], "code string, t bigint, v string")
    for merged in (
        merge.merge_type1(dimension(spark, [("b", "o", 1)]), latest, SPEC, NOW),
        merge.unknown_keys(latest, dimension(spark, [("b", "o", 1)]), "code"),
    ):
        with pytest.raises(Exception, match="null in key column code"):
            merged.collect()


def test_update_rule(spark, broadcast):
    old = dimension(spark, [
        ("newer", "o", 1), ("same", "o", 5), ("older", "o", 9), ("untimed source", "o", 5),
        ("untimed target", "o", None), ("both untimed", "o", None), ("absent", "o", 1),
    ])
    latest = spark.createDataFrame(
        [("newer", 5, "n"), ("same", 5, "n"), ("older", 5, "n"), ("untimed source", None, "n"),
         ("untimed target", 5, "n"), ("both untimed", None, "n"), ("added", 5, "n"), ("added untimed", None, "n")],
        "code string, t bigint, v string",
    )
    merged = merge.merge_type1(old, latest, SPEC, NOW)
    rows = {r.code: r for r in merged.collect()}
    assert {c: r.action for c, r in rows.items()} == {
        "newer": "U", "same": "K", "older": "K", "untimed source": "K", "untimed target": "U",
        "both untimed": "U", "absent": "K", "added": "I", "added untimed": "I",
    }
    assert {c for c, r in rows.items() if r.v == "n"} == {c for c, r in rows.items() if r.action != "K"}
    newer, added, kept = rows["newer"], rows["added"], rows["absent"]
    stamp = lambda value: value.astimezone(UTC)
    assert newer.product_key == 1 and stamp(newer.created_at) == THEN and stamp(newer.updated_at) == NOW
    assert added.product_key is None and stamp(added.created_at) == stamp(added.updated_at) == NOW
    assert stamp(kept.updated_at) == THEN
    counts = merge.change_counts(merged)
    assert {r.action: r.rows for r in counts.collect()} == {"I": 2, "U": 3, "K": 4}


def test_new_rows_take_their_numbers(spark, broadcast):
    latest = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "code string, t bigint, v string")
    numbers = spark.createDataFrame([("b", 7)], "code string, product_key bigint")
    got = merge.merge_type1(dimension(spark, [("a", "o", None)]), latest, SPEC, NOW, numbers)
    assert {r.code: r.product_key for r in got.collect()} == {"a": 1, "b": 7}


def test_facts_are_inserted_once(spark):
    events = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], "product_key bigint, t bigint").withColumn(
        "batch_date", F.lit(date(2026, 1, 2))
    )
    known = spark.createDataFrame([(1, 10)], "product_key bigint, source_t bigint")
    for between in (None, (10, 11)):
        got = merge.new_facts(events, known, SPEC, between)
        assert sorted((r.product_key, r.source_t) for r in got.collect()) == [(1, 11), (2, 10)]


def test_orphans_keep_their_row_counts(spark):
    facts = spark.createDataFrame([(1,), (2,), (2,), (3,)], "product_key bigint")
    known = spark.createDataFrame([(1,)], "product_key bigint")
    got = merge.orphans(facts, known, "product_key")
    assert sorted(map(tuple, got.collect())) == [(2, 2), (3, 1)]


def history(seed=5):
    """Batches with re-read rows, ties, missing times and a very frequent code."""
    rng = random.Random(seed)
    first = date(2026, 1, 1)
    rows = []
    for i in range(900):
        code = "hot" if rng.random() < 0.35 else f"c{rng.randrange(25)}"
        t = rng.choice([None, *range(30)])
        day = rng.randrange(6)
        for again in range(rng.choice([1, 1, 2])):
            rows.append((code, t, f"v{i}", i, first + timedelta(days=min(day + again, 6))))
    return rows


def test_closed_forms_equal_the_daily_loop(spark):
    rows = history()
    staged = spark.createDataFrame(rows, STAGED)
    dim, facts = {}, {}
    for day in sorted({r[4] for r in rows}):
        batch = [r for r in rows if r[4] == day]
        latest = {}
        for code, t, v, i, _ in batch:
            rank = (t is not None, t or 0, i)
            if code not in latest or rank > latest[code][0]:
                latest[code] = (rank, t, v)
        for code, (_, t, v) in latest.items():
            if code not in dim or dim[code][0] is None or (t is not None and t > dim[code][0]):
                dim[code] = (t, v)
        for code, t, _, _, _ in batch:
            if t is not None:
                facts.setdefault((code, t), day)
    closed = merge.dimension_closed_form(staged, SPEC)
    assert {r.code: (r.source_t, r.v) for r in closed.collect()} == dim
    assert {(r.code, r.t): r.batch_date for r in merge.facts_closed_form(staged, SPEC).collect()} == facts


def test_the_merge_operator_repeated_daily_equals_the_closed_form(spark):
    from tidemark.operators.ranking import materialise

    staged = spark.createDataFrame(history(11), STAGED)
    dim = dimension(spark, [("none", "o", 99)]).filter("code = 'never'")
    for day in sorted(r.batch_date for r in staged.select("batch_date").distinct().collect()):
        latest = latest_per_key(staged.filter(F.col("batch_date") == day), SPEC)
        dim = materialise(merge.merge_type1(dim, latest, SPEC, NOW).drop("action"), "loop")
    closed = merge.dimension_closed_form(staged, SPEC)
    columns = ["code", "v", "source_t"]
    assert sorted(map(str, dim.select(*columns).collect())) == sorted(map(str, closed.select(*columns).collect()))


def test_lookup_with_a_hot_code(spark):
    staged = spark.createDataFrame(history(), STAGED)
    events = merge.distinct_events(staged, SPEC)
    dim = staged.select("code").distinct().withColumn("product_key", F.abs(F.xxhash64("code")))
    got = merge.lookup_surrogates(events, dim, SPEC, hot_from=staged, hot_rows=50, small=False)
    assert got.count() == events.count()
    assert sorted(map(str, got.select("code", "t", "product_key").collect())) == sorted(
        map(str, events.join(dim, "code").select("code", "t", "product_key").collect())
    )
