"""Type-1 dimension merge and first-write-wins facts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import HOT_ROWS, skew_join
from tidemark.spec import FeedSpec

INSERT, UPDATE, KEEP = "I", "U", "K"


def is_newer(target_time: Column, source_time: Column) -> Column:
    """Update rule: a target without a time always gives way; otherwise the source
    must be strictly later. A source without a time never replaces one that has it.
    """
    return target_time.isNull() | F.coalesce(source_time > target_time, F.lit(False))


def required_key(key: str) -> Column:
    """The business key; a row without one is an error, in a batch of any size."""
    return F.coalesce(F.col(key), F.raise_error(F.lit(f"null in key column {key}"))).alias(key)


def unknown_keys(latest: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keys of a batch the dimension does not have yet.

    The dimension is reduced to the keys of the batch first. Whether a side is sent to
    all tasks is left to Spark, which goes by bytes; the result is the same either way.
    """
    keys = latest.select(required_key(key))
    known = dimension.select(key).join(keys, key, "left_semi")
    return keys.join(known, key, "left_anti")


def merge_type1(
    dimension: DataFrame,
    latest: DataFrame,
    spec: FeedSpec,
    load_ts: datetime | Column,
    new_keys: DataFrame | None = None,
) -> DataFrame:
    """The dimension after merging one row per key, plus an ``action`` column.

    Matched and newer rows take the new attributes but keep surrogate and
    ``created_at``; unknown keys are added, with their surrogate from ``new_keys``
    (key, surrogate) or null. A null key in the batch is an error. Spark decides by
    bytes whether the batch is sent to the dimension's tasks or both are shuffled.
    """
    stamp = load_ts if isinstance(load_ts, Column) else F.lit(load_ts)
    incoming = latest.select(
        required_key(spec.key),
        F.struct(*spec.attributes, F.col(spec.event_time).alias("t")).alias("_new"),
    )
    target = dimension.withColumn("_known", F.lit(True))
    if new_keys is None:
        new_keys = unknown_keys(latest, dimension, spec.key).withColumn(spec.surrogate, F.lit(None).cast("long"))
    added = incoming.join(new_keys.select(spec.key, F.col(spec.surrogate).alias("_number")), spec.key)
    joined = target.join(incoming, spec.key, "left").unionByName(added, allowMissingColumns=True)
    action = (
        F.when(F.col("_known").isNull(), INSERT)
        .when(
            F.col("_new").isNotNull()
            & is_newer(F.col(spec.target_time), F.col("_new.t")),
            UPDATE,
        )
        .otherwise(KEEP)
    )
    changed = F.col("action") != KEEP
    return joined.withColumn("action", action).select(
        F.coalesce(spec.surrogate, "_number").alias(spec.surrogate),
        spec.key,
        *[
            F.when(changed, F.col(f"_new.{name}")).otherwise(F.col(name)).alias(name)
            for name in spec.attributes
        ],
        F.when(changed, F.col("_new.t")).otherwise(F.col(spec.target_time)).alias(spec.target_time),
        F.coalesce("created_at", stamp).alias("created_at"),
        F.when(changed, stamp).otherwise(F.col("updated_at")).alias("updated_at"),
        "action",
    )


def change_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy("action").agg(F.count(F.lit(1)).alias("rows"))


def distinct_events(staged: DataFrame, spec: FeedSpec, batch: str = "batch_date") -> DataFrame:
    """One row per (key, event time), with the first batch that holds it.

    Rows without an event time are no events.
    """
    return (
        staged.filter(F.col(spec.event_time).isNotNull())
        .groupBy(spec.key, spec.event_time)
        .agg(F.min(batch).alias(batch))
    )


def lookup_surrogates(
    events: DataFrame,
    dimension: DataFrame,
    spec: FeedSpec,
    how: str = "inner",
    hot_from: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    small: bool | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add the surrogate key of each event's business key."""
    return skew_join(
        events,
        dimension.select(spec.key, spec.surrogate),
        [spec.key],
        how,
        [spec.event_time],
        hot_from,
        hot_rows,
        small,
        hot,
    )


def new_facts(
    keyed_events: DataFrame,
    facts: DataFrame,
    spec: FeedSpec,
    between: tuple[int, int] | None = None,
) -> DataFrame:
    """Events that are not in the fact table yet, one per (surrogate, event time).

    ``between`` are the least and greatest event time of the batch: only facts in
    that range can match, and the bounds are pushed into the fact scan.
    """
    known = facts.select(spec.surrogate, spec.target_time)
    if between is not None:
        known = known.filter(F.col(spec.target_time).between(*between))
    fresh = keyed_events.select(
        spec.surrogate, F.col(spec.event_time).alias(spec.target_time), "batch_date"
    )
    return fresh.join(known, [spec.surrogate, spec.target_time], "left_anti")


def orphans(facts: DataFrame, dimension: DataFrame, surrogate: str) -> DataFrame:
    """Surrogates used by facts but missing in the dimension, with their row counts.

    Facts are reduced to one row per surrogate before the join.
    """
    return (
        facts.groupBy(surrogate)
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(dimension.select(surrogate), surrogate, "left_anti")
    )


def dimension_closed_form(staged: DataFrame, spec: FeedSpec, batch: str = "batch_date") -> DataFrame:
    """The dimension after merging all batches in ascending order, in one aggregate.

    The newest event time wins. Among equal times the earliest batch wins, since a
    tie does not update; among rows without a time the latest one wins, since a
    target without a time always gives way.
    """
    day = F.unix_date(F.col(batch))
    rank = F.when(F.col(spec.event_time).isNotNull(), -day).otherwise(day)
    row = F.struct(*spec.attributes, F.col(spec.event_time).alias(spec.target_time))
    return (
        staged.groupBy(spec.key)
        .agg(F.max_by(row, spec.newest(rank)).alias("_row"))
        .select(spec.key, "_row.*")
    )


def facts_closed_form(staged: DataFrame, spec: FeedSpec) -> DataFrame:
    """The facts after all batches in ascending order: first batch per event."""
    return distinct_events(staged, spec)


