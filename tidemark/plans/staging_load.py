"""Staging load: the objects of a committed run replace their earlier rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, date, datetime

from pyspark.sql import functions as F

from tidemark.errors import TidemarkError
from tidemark.operators import control, quality
from tidemark.plans.raw_load import Source, marker_location
from tidemark.schema import empty, required_columns
from tidemark.session import releases_scratch
from tidemark.sinks import files, staging
from tidemark.sinks.tables import Snapshot, TableStore
from tidemark.sources.commits import read_manifest
from tidemark.sources.tables import scan_raw


def slot_of(source: str, batch_date: date | str) -> str:
    """Slot of one source and date, in staging and in the facts."""
    return f"{source}/{batch_date}"


def write_metrics(store: TableStore, base: Snapshot, layer: str, source: str, rows: list, recorded: datetime) -> dict:
    """Upsert the metrics of one gate; returns the slot change.

    A slot holds all dates of a layer and source, a few rows per date, so that a metric
    is stored once whichever load writes it.
    """
    slot = f"{layer}/{source}"
    schema = store.schemas["dq_metrics"]
    fresh = store.spark.createDataFrame(
        [(*row, recorded) for row in (tuple(r) for r in rows)], schema
    )
    if slot in base.slots.get("dq_metrics", {}):
        fresh = quality.upsert_metrics(store.read("dq_metrics", [slot], base), fresh)
    path = store.write("dq_metrics", fresh)
    return {"dq_metrics": {slot: [path]}}


@releases_scratch
def reload_staging(store: TableStore, raw_root: str, source: Source, batch_dates: Sequence[date]) -> dict[date, int]:
    """Reload staging for several batches in one scan and one write; rows per batch.

    All batches and the gate's metrics become visible together, after the gate has passed
    for every batch. A date without a committed run is an error.
    """
    spark = store.spark
    dates = sorted(set(batch_dates))
    locations = {day: marker_location(raw_root, source.name, day) for day in dates}
    for day, location in locations.items():
        if not files.exists(spark, location):
            raise TidemarkError(f"no committed run of {source.name} for {day}")
    markers = {day: files.read_json(spark, location) for day, location in locations.items()}
    now = datetime.now(UTC)
    base = store.snapshot()
    slots = {day: slot_of(source.name, day) for day in dates}

    expected = {day: 0 for day in dates}
    keys = [m["manifest_key"] for m in markers.values() if m["object_count"]]
    if keys:
        manifest = read_manifest(spark, raw_root, *keys)
        checked = control.reconcile_manifests(manifest)
        control.require_reconciled(checked)
        expected |= {row.logical_date: row.declared_rows for row in checked.select("logical_date", "declared_rows").collect()}
        listed = control.manifest_objects(manifest).select(
            F.col("logical_date").alias("batch_date"), F.col("object_key").alias("raw_object_key")
        )
        raw = scan_raw(spark, *[f"{raw_root}/{key.rpartition('/')[0]}" for key in keys], schema=source.schema)
    else:
        raw = empty(spark, source.schema).withColumn("raw_object_key", F.lit(""))
        listed = spark.createDataFrame([], "batch_date date, raw_object_key string")
    # Of the attempts' folders, the objects that the manifests list, under their date.
    fresh = staging.with_lineage(raw, F.lit(None).cast("date"), now, raw_root).drop("batch_date").join(listed, "raw_object_key")
    stored = store.read("staging", slots.values(), base)
    rows = staging.replace_objects(stored, fresh, listed)
    # The rows of one batch are written as they come; rows of several are sorted by their folder.
    parts = {str(dates[0]): [store.write("staging", rows)]} if len(dates) == 1 else store.write_parts("staging", rows, "batch_date", True)

    written = store.open("staging", [path for paths in parts.values() for path in paths])
    wanted = spark.createDataFrame(list(expected.items()), "batch_date date, expected_rows bigint")
    rows = quality.enforce(quality.staging_gate(written, wanted, source.spec.key, source.name))
    quality.enforce_table(written, "staging", (), required_columns(store.schemas["staging"]))
    metrics = write_metrics(store, base, "staging", source.name, rows, now)
    store.publish(base, {"staging": {slots[day]: parts.get(str(day), []) for day in dates}, **metrics})
    return expected


def load_staging(store: TableStore, raw_root: str, source: Source, batch_date: date) -> int:
    """Reload staging for one batch and return the rows inserted."""
    return reload_staging(store, raw_root, source, [batch_date])[batch_date]
