"""Pages of an ordered source: cutting, bounds, counts and where to stop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import running_total, with_ordinal

PAGE_SIZE = 50


def newest_first(event_time: str, tie_break: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last(event_time), *[F.desc_nulls_last(c) for c in tie_break]]


def paginate(df: DataFrame, order: Sequence[Column], page_size: int = PAGE_SIZE) -> DataFrame:
    """1-based pages of a fixed size over a totally ordered source."""
    if page_size < 1:
        raise ValueError("page_size must be at least 1.")
    ordinal = F.col("_ordinal") - 1
    return (
        with_ordinal(df, order, "_ordinal")
        .withColumn("page_number", F.floor(ordinal / page_size) + 1)
        .withColumn("page_position", ordinal % page_size + 1)
        .drop("_ordinal")
    )


def page_bounds(df: DataFrame, event_time: str, page: str = "page_number") -> DataFrame:
    """Newest and oldest usable event time of each page; null when it has none."""
    return df.groupBy(page).agg(
        F.max(event_time).alias("newest_t"), F.min(event_time).alias("oldest_t")
    )


def page_stats(
    df: DataFrame, event_time: str, inside: Column, page: str = "page_number"
) -> DataFrame:
    """Bounds and counts of each page in one aggregate."""
    return df.groupBy(page).agg(
        F.max(event_time).alias("newest_t"),
        F.min(event_time).alias("oldest_t"),
        F.count(F.lit(1)).alias("returned"),
        F.count_if(inside).alias("in_window"),
    )


def running_seen(stats: DataFrame, by: Sequence[str] = (), page: str = "page_number") -> DataFrame:
    """Records seen up to and including each page, in or out of the window."""
    return running_total(stats, by, [page], "returned", "total_seen")


def require_page_cap(max_pages: int | None) -> None:
    if max_pages is not None and max_pages < 1:
        # Fixed text that callers match: "max_pages must be at least 1".
        raise ValueError(f"max_pages must be at least 1, not {max_pages}")


def stop_page(
    stats: DataFrame,
    start: Column,
    max_pages: int | None = None,
    page: str = "page_number",
    declared: str = "declared_count",
) -> DataFrame:
    """Where a newest-first scan ends, as one row: stop_page, last_page, reason.

    A page that is empty or entirely older than ``start`` ends the scan before it; one
    that completes the declared count, or reaches the cap, ends it after it. A page
    without any usable time never ends the scan for age. ``reason`` is ``exhausted``
    when no page ended it. Only ``page_cap`` means the scan is incomplete.
    """
    require_page_cap(max_pages)
    capped = F.lit(False) if max_pages is None else F.col(page) >= max_pages
    # Checked in this order on each page; the first two leave the page out.
    ending = (
        F.when(F.col("returned") == 0, "1 empty_page")
        .when(F.col("newest_t") < start, "2 too_old")
        .when(F.col("total_seen") >= F.col(declared), "3 all_seen")
        .when(capped, "4 page_cap")
    )
    ends = stats.select(F.col(page).alias("page"), ending.alias("ending"))
    first = F.min(F.when(F.col("ending").isNotNull(), F.struct("page", "ending")))
    return ends.agg(first.alias("stop"), F.max("page").alias("final")).select(
        F.col("stop.page").alias("stop_page"),
        F.when(F.col("stop").isNull(), F.col("final"))
        .when(F.col("stop.ending") < "3", F.col("stop.page") - 1)
        .otherwise(F.col("stop.page"))
        .alias("last_page"),
        F.coalesce(F.substring("stop.ending", 3, 20), F.lit("exhausted")).alias("reason"),
    )


def page_cap(df: DataFrame, max_pages: int, page: str = "page_number") -> DataFrame:
    require_page_cap(max_pages)
    return df.filter(F.col(page) <= max_pages)
