from __future__ import annotations

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.errors import WindowError
from tidemark.functions import times
from tidemark.operators import windows


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


SOURCES = "source_name string, initial_watermark timestamp, batch_end timestamp, lookback interval day to second"


def build(spark, current, initial, end, lookback=timedelta(0)):
    sources = spark.createDataFrame([("s", at(initial), at(end), lookback)], SOURCES)
    rows = [("s", at(current))] if current else []
    return windows.build_windows(
        sources, spark.createDataFrame(rows, "source_name string, watermark_ts timestamp")
    )


@pytest.mark.parametrize(
    ("current", "initial", "end", "lookback", "incremental", "start"),
    [
        (None, "2026-08-01", "2026-08-20", 0, "2026-08-01", "2026-08-01"),
        ("2026-08-19", "2026-08-01", "2026-08-20", 0, "2026-08-19", "2026-08-19"),
        ("2026-08-19", "2026-08-01", "2026-08-20", 6, "2026-08-19", "2026-08-18T18:00"),
        ("2026-08-01T02:00", "2026-08-01", "2026-08-02", 6, "2026-08-01T02:00", "2026-08-01"),
    ],
)
def test_window(spark, current, initial, end, lookback, incremental, start):
    row = windows.require_windows(build(spark, current, initial, end, timedelta(hours=lookback))).select(
        *[F.unix_timestamp(c).alias(c) for c in windows.WINDOW_COLUMNS[1:]]
    ).first()
    seconds = lambda text: int(at(text).timestamp())
    assert row.previous_watermark == (seconds(current) if current else None)
    assert row.incremental_start == seconds(incremental)
    assert row.extract_start == seconds(start)
    assert row.extract_end == row.next_watermark == seconds(end)


@pytest.mark.parametrize(
    ("current", "end", "lookback", "message"),
    [
        ("2026-08-20", "2026-08-20", 0, "batch_end must be later"),
        (None, "2026-08-20", -1, "lookback is below zero"),
        ("2026-07-31", "2026-08-20", 0, "lies before initial_watermark"),
    ],
)
def test_window_errors(spark, current, end, lookback, message):
    built = build(spark, current, "2026-08-01", end, timedelta(hours=lookback))
    with pytest.raises(WindowError, match=message):
        windows.require_windows(built)


def test_zoneless_times_are_refused():
    with pytest.raises(ValueError, match="timezone-aware"):
        times.require_aware(datetime(2026, 8, 1), "initial_watermark")
    with pytest.raises(ValueError, match="ends where it starts"):
        windows.in_window("t", at("2026-08-20"), at("2026-08-20"))


def test_window_is_half_open(spark):
    start, end = at("2026-08-19"), at("2026-08-20")
    offsets = {"inside": 43_200, "at start": 0, "at end": 86_400, "before": -60, "none": None}
    rows = [(name, None if o is None else int(start.timestamp()) + o) for name, o in offsets.items()]
    kept = windows.window_filter(spark.createDataFrame(rows, "name string, t bigint"), "t", start, end)
    assert {row.name for row in kept.collect()} == {"inside", "at start"}


def test_fractional_bounds_round_up():
    assert times.epoch_of(datetime(1970, 1, 1, 0, 0, 1, 500_000, tzinfo=UTC)) == 2
    assert times.epoch_of(datetime(1970, 1, 1, 0, 0, 1, tzinfo=UTC)) == 1


def test_assigned_windows_match_brute_force(spark):
    spans = [("a", 0, 100), ("b", 90, 250), ("c", 250, 251), ("d", 40, 41), ("e", 300, 300)]
    events = [(i, i * 7 % 260) for i in range(300)] + [(1000 + i, 95) for i in range(200)] + [(5000, None)]
    windowed = spark.createDataFrame(spans, "name string, s bigint, e bigint").select(
        "name", F.timestamp_seconds("s").alias("extract_start"), F.timestamp_seconds("e").alias("extract_end")
    )
    feed = spark.createDataFrame(events, "id bigint, t bigint")
    expected = sorted((i, n) for i, t in events for n, s, e in spans if t is not None and s <= t < e)
    for small in (False, True):
        got = windows.assign_windows(
            feed, windowed, "t", ["id"], cell_seconds=50, hot_rows=60, small=small
        )
        assert sorted((r.id, r.name) for r in got.collect()) == expected


def test_daily_batches_cover_day_and_lookback(spark):
    day = 86_400
    rows = [(0,), (day - 6 * 3600 - 1,), (day - 6 * 3600,), (day - 1,), (day,)]
    got = spark.createDataFrame(rows, "t bigint").select("t", windows.daily_batches("t", 6 * 3600).alias("d"))
    assert [[d.day for d in r.d] for r in got.orderBy("t").collect()] == [[2], [2], [2, 3], [2, 3], [3]]


def test_iso_text_matches_python(spark):
    stamps = [datetime(2026, 8, 19, 12, tzinfo=UTC), datetime(2026, 8, 19, 12, 0, 0, 1234, tzinfo=UTC)]
    frame = spark.createDataFrame([(s,) for s in stamps], "ts timestamp")
    assert sorted(r.x for r in frame.select(times.iso_text("ts").alias("x")).collect()) == sorted(
        s.isoformat() for s in stamps
    )
