"""Extraction windows and the rows inside them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import WindowError
from tidemark.functions.times import DAY_SECONDS, epoch_of, require_aware
from tidemark.operators.joins import HOT_ROWS, skew_join

WINDOW_COLUMNS = (
    "source_name",
    "previous_watermark",
    "incremental_start",
    "extract_start",
    "extract_end",
    "next_watermark",
)


def build_windows(sources: DataFrame, watermarks: DataFrame) -> DataFrame:
    """One window per source.

    ``sources``: source_name, initial_watermark, batch_end, lookback (interval).
    ``watermarks``: source_name, watermark_ts; a source without a row has never run.
    The ``error`` column is null for a usable window.
    """
    zero = F.make_dt_interval(F.lit(0))
    current = F.col("watermark_ts")
    start = F.coalesce(current, F.col("initial_watermark"))
    joined = sources.join(watermarks.select("source_name", "watermark_ts"), "source_name", "left")
    return joined.select(
        "source_name",
        current.alias("previous_watermark"),
        start.alias("incremental_start"),
        F.greatest("initial_watermark", start - F.col("lookback")).alias("extract_start"),
        F.col("batch_end").alias("extract_end"),
        F.col("batch_end").alias("next_watermark"),
        # Fixed text that callers match: "batch_end must be later".
        F.when(F.col("lookback") < zero, "lookback is below zero")
        .when(
            current < F.col("initial_watermark"),
            "current_watermark lies before initial_watermark",
        )
        .when(F.col("batch_end") <= start, "batch_end must be later than where the batch starts")
        .alias("error"),
    )


def require_windows(windows: DataFrame) -> DataFrame:
    """The windows without their error column; raises when one has an error."""
    bad = windows.filter(F.col("error").isNotNull()).limit(20).collect()
    if bad:
        raise WindowError("; ".join(f"{row.source_name}: {row.error}" for row in bad))
    return windows.select(*WINDOW_COLUMNS)


def _bound(value: datetime | Column) -> Column:
    return F.lit(epoch_of(value)) if isinstance(value, datetime) else value


def in_window(event_time: Column | str, start: datetime | Column, end: datetime | Column) -> Column:
    """``start <= event_time < end`` on whole epoch seconds.

    Comparing the stored seconds with literals lets both bounds reach the scan.
    """
    if isinstance(start, datetime) and isinstance(end, datetime):
        if require_aware(end, "extract_end") <= require_aware(start, "extract_start"):
            raise ValueError("the window ends where it starts, or before")
    column = F.col(event_time) if isinstance(event_time, str) else event_time
    return (column >= _bound(start)) & (column < _bound(end))


def window_filter(df: DataFrame, event_time: str, start: datetime, end: datetime) -> DataFrame:
    """Rows inside the half-open window; a null event time is outside."""
    return df.filter(in_window(event_time, start, end))


def assign_windows(
    feed: DataFrame,
    windows: DataFrame,
    event_time: str,
    spread: Sequence[str],
    by: Sequence[str] = (),
    cell_seconds: int = DAY_SECONDS,
    hot_rows: int = HOT_ROWS,
    small: bool | None = None,
) -> DataFrame:
    """Pair every row with every window that holds it.

    A range join turned into an equi-join: time is cut into cells, each window is
    listed under the cells it touches, and rows meet windows of their own cell only.
    ``windows`` needs extract_start and extract_end next to the ``by`` columns; its
    other columns are carried. A short list of windows is broadcast; with a long one
    the rows of a busy cell are split like any hot key.
    """
    first = F.ceil(F.unix_micros("extract_start") / 1_000_000).cast("long")
    last = F.ceil(F.unix_micros("extract_end") / 1_000_000).cast("long")
    cells = (
        windows.withColumn("_start", first)
        .withColumn("_end", last)
        .filter("_start < _end")
        .withColumn(
            "_cell",
            F.explode(
                F.sequence(
                    F.floor(F.col("_start") / cell_seconds),
                    F.floor((F.col("_end") - 1) / cell_seconds),
                )
            ),
        )
    )
    placed = feed.filter(F.col(event_time).isNotNull()).withColumn(
        "_cell", F.floor(F.col(event_time) / cell_seconds)
    )
    joined = skew_join(
        placed, cells, [*by, "_cell"], "inner", spread, hot_rows=hot_rows, small=small
    )
    return joined.filter(
        (F.col(event_time) >= F.col("_start")) & (F.col(event_time) < F.col("_end"))
    ).drop("_cell", "_start", "_end")


def daily_batches(event_time: Column | str, lookback_seconds: int) -> Column:
    """Dates of all daily windows, each reaching back ``lookback_seconds`` more, that
    hold an event; by arithmetic, so a backfill needs no join at all.
    """
    column = F.col(event_time) if isinstance(event_time, str) else event_time
    first = F.floor(column / DAY_SECONDS) + 1
    last = F.floor((column + lookback_seconds) / DAY_SECONDS) + 1
    return F.transform(F.sequence(first, last), lambda day: F.date_from_unix_date(day.cast("int")))


LATE_COUNTS = ("received_rows", "untimed_rows", "late_rows", "new_events", "reread_events")


def late_counts(staged: DataFrame, inserted: DataFrame, spec, batch: str = "batch_date") -> DataFrame:
    """Per batch of a load: rows received, rows without a time, rows from before the
    batch's own day, events that became facts (``inserted``) and events that were known.
    """
    time = F.col(spec.event_time)
    day_start = (F.unix_date(F.col(batch)) - 1).cast("long") * DAY_SECONDS
    # One row per batch, key and time first, so that no batch is counted in one task.
    per_event = staged.groupBy(batch, spec.key, spec.event_time).agg(F.count(F.lit(1)).alias("_rows"))
    rows_if = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("_rows"))), F.lit(0))
    seen = per_event.groupBy(batch).agg(
        F.sum("_rows").alias("received_rows"),
        rows_if(time.isNull()).alias("untimed_rows"),
        rows_if(time < day_start).alias("late_rows"),
        F.count(time).alias("_events"),
    )
    new = inserted.groupBy(batch).agg(F.count(F.lit(1)).alias("new_events"))
    return (
        seen.join(new, batch, "left")
        .withColumn("new_events", F.coalesce("new_events", F.lit(0)))
        .withColumn("reread_events", F.col("_events") - F.col("new_events"))
        .drop("_events")
    )


def reread_counts(staged: DataFrame, spec, batch: str = "batch_date") -> DataFrame:
    """Per batch: rows, rows re-read through the lookback, and events never seen in
    an earlier batch.
    """
    time = F.col(spec.event_time)
    day_start = (F.unix_date(F.col(batch)) - 1).cast("long") * DAY_SECONDS
    per_batch = staged.groupBy(batch).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(time < day_start).alias("reread_rows"),
    )
    first_seen = (
        staged.filter(time.isNotNull())
        .groupBy(spec.key, spec.event_time)
        .agg(F.min(batch).alias(batch))
        .groupBy(batch)
        .agg(F.count(F.lit(1)).alias("new_events"))
    )
    return per_batch.join(first_seen, batch, "left").withColumn(
        "new_events", F.coalesce("new_events", F.lit(0))
    )
