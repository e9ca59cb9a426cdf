"""Staged files as a stream into the mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import instant
from tidemark.operators.ranking import materialise
from tidemark.plans.mart_load import merge_batch
from tidemark.plans.staging_load import slot_of
from tidemark.session import temporary
from tidemark.sinks.tables import TableStore
from tidemark.spec import FeedSpec

# Pointers a stream leaves behind, and after how many micro-batches it removes older ones.
POINTERS_KEPT = 20
EXPIRE_EVERY = 50

# Layer of the metrics that add up what micro-batches held, per batch date: rows, rows
# without a time, late rows, new events and events read again.
ACCOUNT = "stream"

# Store property naming the last micro-batch of a stream that was published.
APPLIED = "stream-applied:"


def drop_rereads(stream: DataFrame, spec: FeedSpec, delay: str) -> DataFrame:
    """Drop events already seen within ``delay``.

    The delay has to cover the lookback: an event older than the watermark would be
    dropped. State is bounded by the events of one delay. Optional, because the merge
    and the facts ignore events they already have.
    """
    return (
        stream.withColumn("_event_ts", instant(spec.event_time))
        .withWatermark("_event_ts", delay)
        .dropDuplicatesWithinWatermark([spec.key, spec.event_time])
        .drop("_event_ts")
    )


def start_mart_stream(
    stream: DataFrame,
    store: TableStore,
    spec: FeedSpec,
    source: str,
    checkpoint: str,
    name: str = "mart",
    **trigger: object,
) -> StreamingQuery:
    """Merge every micro-batch of staged rows into the mart.

    The number of a micro-batch is published with its tables, so one that is delivered
    again after a failure is recognised and skipped, and its rows are accounted for once:
    the counts (see ``late_counts``) are published with the tables too. Rows that
    ``drop_rereads`` dropped before are not among them. ``name`` belongs to the checkpoint:
    a stream started over with a new checkpoint needs a new name.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        # Written once: the load reads its rows several times, and state has to be
        # updated in all partitions even when the batch turns out to be done already.
        with temporary(store.spark):
            rows = materialise(batch, "micro-batch")
            done = int(store.snapshot().properties.get(APPLIED + name, "-1"))
            if batch_id > done and not rows.isEmpty():
                merge_batch(
                    store, rows, slot_of(source, name), spec, source, {APPLIED + name: str(batch_id)}, account=ACCOUNT
                )
                if batch_id % EXPIRE_EVERY == EXPIRE_EVERY - 1:
                    store.expire(POINTERS_KEPT)

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_staged(store: TableStore, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of the staged Parquet files under ``path``."""
    return (
        store.spark.readStream.schema(store.schemas["staging"])
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )
