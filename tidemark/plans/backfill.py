"""The whole chain for many dates at once: raw, staging and mart."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.errors import GateError, WindowError
from tidemark.functions import identity, times
from tidemark.operators import conform, control
from tidemark.operators.joins import BROADCAST_ROWS
from tidemark.operators.ranking import materialise
from tidemark.operators.windows import assign_windows, build_windows, window_filter
from tidemark.plans.mart_load import MartLoad, merge_batch
from tidemark.plans.raw_load import RawRun, Source, marker_location, marker_payload, recover, result_of, run_folder, run_id_of
from tidemark.plans.staging_load import reload_staging, slot_of
from tidemark.schema import shaped
from tidemark.session import releases_scratch, scratch_path
from tidemark.sinks import files, landing
from tidemark.sinks.tables import TableStore

_RUN = ("extract_date", "run_id", "attempt_id")


@dataclass(frozen=True)
class ChainBackfill:
    runs: list[RawRun]
    staged_rows: dict[date, int]
    mart: MartLoad


def windows_of(store: TableStore, source: Source, ends: Sequence[datetime]) -> DataFrame:
    """One window per batch end, as daily loads in ascending order would get them.

    Each window starts from the end before it, the first one from the stored watermark.
    """
    known = store.read("watermarks", [source.name]).select("watermark_ts").first()
    before = [known.watermark_ts if known else None, *ends[:-1]]
    spark = store.spark
    labels = [str(end.date()) for end in ends]
    sources = spark.createDataFrame(list(zip(labels, ends, strict=True)), "source_name string, batch_end timestamp").select(
        "source_name",
        F.lit(times.require_aware(source.initial_watermark, "initial_watermark")).alias("initial_watermark"),
        "batch_end",
        F.lit(source.lookback).alias("lookback"),
    )
    reached = [(label, at) for label, at in zip(labels, before, strict=True) if at is not None]
    marks = spark.createDataFrame(reached, "source_name string, watermark_ts timestamp")
    return build_windows(sources, marks).withColumn("extract_date", F.to_date("source_name"))


def _committed(store: TableStore, raw_root: str, source: Source, days: Sequence[date]) -> dict[date, dict]:
    found = {day: marker_location(raw_root, source.name, day) for day in days}
    return {day: files.read_json(store.spark, at) for day, at in found.items() if files.exists(store.spark, at)}


@releases_scratch
def backfill_raw(
    store: TableStore, raw_root: str, source: Source, batch_ends: Sequence[datetime], records: DataFrame
) -> list[RawRun]:
    """Land and commit the batches of many dates with one pass over the source.

    Every record goes to all windows that hold it. All batches are landed by one write,
    listed by one scan and gated by one aggregate; then the dates are committed one by one
    in ascending order, and the watermark moves once, to the last. A failed gate commits
    none of them. Dates that are committed already are not read again. A crash between
    commits leaves the earlier dates committed; the next run goes on from there.
    """
    spark, spec = store.spark, source.spec
    ends = sorted({times.require_aware(e, "batch_end").replace(hour=0, minute=0, second=0, microsecond=0) for e in batch_ends})
    if not ends:
        return []
    attempt, started = uuid.uuid4().hex, datetime.now(UTC)
    done = _committed(store, raw_root, source, [e.date() for e in ends])
    if done:
        # As after a crash between commit and advance.
        recover(store, done[max(done)])
    open_ends = [e for e in ends if e.date() not in done]
    if open_ends:
        windows = materialise(windows_of(store, source, open_ends), "windows")
        span = windows.agg(F.min("extract_start"), F.max("extract_end")).first()
        bad = windows.where("error IS NOT NULL").orderBy("source_name").limit(1).collect()
        if bad:
            raise WindowError(f"{source.name}: {bad[0].source_name}: {bad[0].error}")
        inside = window_filter(
            conform.require_types(records, source.schema), spec.event_time, span[0].astimezone(UTC), span[1].astimezone(UTC)
        )
        placed = assign_windows(
            shaped(inside, source.schema), windows.select("extract_date", "extract_start", "extract_end"), spec.event_time,
            [spec.key], small=len(open_ends) <= BROADCAST_ROWS,
        ).drop("extract_start", "extract_end").withColumns(
            {"run_id": identity.run_id(F.lit(source.name), F.col("extract_date")), "attempt_id": F.lit(attempt)}
        )
        base = f"{raw_root}/{source.name}"
        written = landing.land_batches(placed, base, _RUN, spec.event_time, spec.key)
        folders = {e.date(): f"{run_folder(raw_root, source.name, e.date())}/attempt_id={attempt}" for e in open_ends}
        filled = [path for path in folders.values() if files.exists(spark, path)]
        totals = _check(store, source, raw_root, base, filled, written, started) if filled else {}
        for window in sorted(windows.collect(), key=lambda w: w.extract_date):
            rows, objects = totals.get(window.extract_date, (0, 0))
            payload = marker_payload(
                source.name, window.extract_date, attempt, folders[window.extract_date][len(raw_root) + 1 :], objects, rows,
                window.extract_start.astimezone(UTC), window.extract_end.astimezone(UTC),
            )
            location = marker_location(raw_root, source.name, window.extract_date)
            if not files.create_json(spark, location, payload):
                payload = files.read_json(spark, location)
            done[window.extract_date] = payload
        recover(store, done[max(done)])
    return [result_of(done[day], attempt) for day in sorted(done)]


def _check(store, source: Source, raw_root: str, base: str, filled: list[str], written: int, started: datetime) -> dict:
    """Verify, gate and list what was landed; (rows, objects) per date."""
    spark = store.spark
    objects = landing.inventory(spark, filled, raw_root)
    part = lambda name: F.regexp_extract("object_key", f"/{name}=([^/]+)/", 1)
    objects = materialise(
        objects.withColumns(
            {"source": F.lit(source.name), "logical_date": part("extract_date").cast("date"), "run_id": part("run_id"), "attempt_id": part("attempt_id")}
        ),
        "objects",
    )
    landing.verify_landing(objects, written)
    key = F.col(source.spec.key)
    bad = (
        spark.read.option("basePath", base).parquet(*filled)
        .groupBy("extract_date").agg(F.count_if(key.isNull()).alias("null_keys"))
        .where("null_keys > 0").orderBy("extract_date").limit(1).collect()
    )
    if bad:
        raise GateError(f"Found {bad[0].null_keys} records with null keys in the batch of {bad[0].extract_date}.")
    documents = control.build_manifests(objects)
    manifest = control.manifest_json(F.lit(started), F.current_timestamp()).alias("value")
    folder = scratch_path(spark, "manifests")
    documents.select(manifest, F.col("logical_date").alias("extract_date")).write.partitionBy("extract_date").text(folder)
    for path in filled:
        day = path.rpartition("/extract_date=")[2].partition("/")[0]
        files.move(spark, f"{folder}/extract_date={day}", f"{path}/{identity.MANIFEST_NAME}")
    totals = control.run_totals(objects, ("logical_date",)).collect()
    return {row.logical_date: (row.row_count, row.object_count) for row in totals}


def backfill_chain(
    store: TableStore, raw_root: str, source: Source, batch_ends: Sequence[datetime], records: DataFrame
) -> ChainBackfill:
    """Raw, staging and mart for many batch ends; what daily loads would leave behind.

    Works on an empty and on a filled mart. ``records`` is the source with the columns of
    the raw schema. Running it again changes nothing.
    """
    runs = backfill_raw(store, raw_root, source, batch_ends, records)
    days = [run.logical_date for run in runs]
    staged = reload_staging(store, raw_root, source, days)
    batches = store.spark.createDataFrame([(day,) for day in days], "batch_date date")
    rows = store.read("staging", [slot_of(source.name, day) for day in days])
    mart = merge_batch(store, rows, None, source.spec, source.name, batches=batches)
    return ChainBackfill(runs, staged, mart)
