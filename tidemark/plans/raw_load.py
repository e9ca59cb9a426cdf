"""Raw load: window, filter, land, check, manifest, commit, advance."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, date, datetime, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import WindowError
from tidemark.functions import identity, times
from tidemark.operators import conform, control, quality
from tidemark.operators.ranking import materialise
from tidemark.operators.windows import build_windows, window_filter
from tidemark.schema import RAW, WATERMARKS, shaped
from tidemark.session import releases_scratch
from tidemark.sinks import files, landing
from tidemark.sinks.tables import Snapshot, TableStore
from tidemark.spec import PRODUCTS, FeedSpec


class Scan(NamedTuple):
    """Records of a window, whether the scan of the source was complete, and its rejects.

    ``rejects`` has one row per record without a usable event time: the key, a ``reason``
    and any place columns; None for a source that does not account for them.
    """

    rows: DataFrame
    complete: bool
    rejects: DataFrame | None = None


# Gives the scan for the bounds of a window.
Reader = Callable[[datetime, datetime], Scan]

REJECTS = "_rejects"
REJECT_METRIC = "rejected_records"


@dataclass(frozen=True)
class Source:
    """A source and where its extraction starts."""

    name: str
    initial_watermark: datetime
    lookback: timedelta = timedelta(0)
    spec: FeedSpec = field(default=PRODUCTS)
    schema: T.StructType = field(default_factory=lambda: RAW)


@dataclass(frozen=True)
class RawRun:
    source: str
    logical_date: date
    run_id: str
    attempt_id: str
    committed: bool
    rows: int
    objects: int
    rejected: int | None = None


def run_id_of(source: str, logical_date: date) -> str:
    """Python twin of ``identity.run_id``."""
    name = f"{identity.RUN_NAME_PREFIX}{source}:{logical_date.isoformat()}"
    return uuid.uuid5(uuid.NAMESPACE_URL, name).hex


def run_folder(root: str, source: str, logical_date: date) -> str:
    run = run_id_of(source, logical_date)
    return f"{root}/{source}/extract_date={logical_date}/run_id={run}"


def marker_location(root: str, source: str, logical_date: date) -> str:
    return f"{run_folder(root, source, logical_date)}/{identity.MARKER_NAME}"


def window_of(store: TableStore, source: Source, batch_end: datetime):
    """The extraction window row of one source, from the published watermarks."""
    sources = store.spark.range(1).select(
        F.lit(source.name).alias("source_name"),
        F.lit(times.require_aware(source.initial_watermark, "initial_watermark")).alias("initial_watermark"),
        F.lit(times.require_aware(batch_end, "batch_end")).alias("batch_end"),
        F.lit(source.lookback).alias("lookback"),
    )
    window = build_windows(sources, store.read("watermarks", [source.name])).first()
    if window.error:
        raise WindowError(f"{source.name}: {window.error}")
    return window


def recover(store: TableStore, marker: dict) -> None:
    """Finish the watermark update of a committed run; a no-op when it is done.

    Every source has its own slot of the table, so sources do not wait for each other.
    """
    base = store.snapshot()
    name = marker["source"]
    commit = store.spark.range(1).select(
        F.lit(name).alias("source_name"),
        F.lit(datetime.fromisoformat(marker["next_watermark"])).alias("watermark_ts"),
        F.lit(marker["run_id"]).alias("run_id"),
    )
    result = materialise(
        control.advance_watermarks(
            store.read("watermarks", [name], base), commit, F.current_timestamp()
        ),
        "watermarks",
    )
    changes = {}
    if not result.filter("changed").isEmpty():
        changes["watermarks"] = {name: [store.write("watermarks", result.select(*WATERMARKS.fieldNames()))]}
    if marker.get("reject_count") is not None:
        changes |= _reject_metric(store, base, marker)
    if changes:
        store.publish(base, changes)


def _reject_metric(store: TableStore, base: Snapshot, marker: dict) -> dict:
    """Slot change for the number of rejects of a run, unless it is stored; it never fails a load."""
    slot = f"raw/{marker['source']}"
    day = date.fromisoformat(marker["logical_date"])
    stored = store.read("dq_metrics", [slot], base)
    fresh = store.spark.createDataFrame(
        [(marker["source"], "raw", day, REJECT_METRIC, marker["reject_count"], True, None, datetime.now(UTC))], store.schemas["dq_metrics"]
    )
    same = stored.join(fresh.select(*quality.METRIC_KEY, "metric_value"), [*quality.METRIC_KEY, "metric_value"], "left_semi")
    if not same.isEmpty():
        return {}
    return {"dq_metrics": {slot: [store.write("dq_metrics", quality.upsert_metrics(stored, fresh))]}}


def marker_payload(
    source: str, logical_date: date, attempt: str, prefix: str, objects: int, rows: int, start_at: datetime, end_at: datetime,
    rejected: int | None = None,
) -> dict:
    """The commit record of an attempt; ``prefix`` is its folder below the raw root."""
    return {
        "schema_version": control.MARKER_VERSION,
        "source": source,
        "logical_date": str(logical_date),
        "run_id": run_id_of(source, logical_date),
        "attempt_id": attempt,
        "manifest_key": f"{prefix}/{identity.MANIFEST_NAME}",
        "object_count": objects,
        "row_count": rows,
        **({} if rejected is None else {"reject_count": rejected}),
        "extract_start": start_at.isoformat(),
        "extract_end": end_at.isoformat(),
        "next_watermark": end_at.isoformat(),
        "committed_at": datetime.now(UTC).isoformat(),
    }


def result_of(marker: dict, attempt: str) -> RawRun:
    return RawRun(
        marker["source"],
        date.fromisoformat(marker["logical_date"]),
        marker["run_id"],
        marker["attempt_id"],
        marker["attempt_id"] == attempt,
        marker["row_count"],
        marker["object_count"],
        marker.get("reject_count"),
    )


def land_rejects(rejects: DataFrame, folder: str, source: str, logical_date: date) -> int:
    """Write the rejects next to the attempt's data, in the same pass that counts them."""
    counted = Observation()
    (
        rejects.withColumns({"source": F.lit(source), "logical_date": F.lit(logical_date)})
        .observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.parquet(f"{folder}/{REJECTS}")
    )
    return counted.get["rows"]


@releases_scratch
def load_raw(
    store: TableStore,
    raw_root: str,
    source: Source,
    batch_end: datetime,
    records: DataFrame | Reader,
    page: str | None = None,
) -> RawRun:
    """Land the records of one batch and commit them once.

    ``records`` is the source with the columns of its schema (others are left out; a
    wrong type is an error before anything is landed), or a function of the window's bounds giving
    it; the window filter is applied here and reaches its scan. With ``page`` the keys
    must be unique inside each page; the column is landed with the data for that check.
    Rejects of the reader are written next to the data and counted in the commit record
    and as a metric of the raw layer.
    A scan the reader calls incomplete (page cap reached) is landed but neither
    committed nor counted in the watermark. A run that is committed already is not
    read again.
    """
    spark: SparkSession = store.spark
    spec, schema = source.spec, source.schema
    end = times.require_aware(batch_end, "batch_end").replace(hour=0, minute=0, second=0, microsecond=0)
    label = end.date()
    marker_path = marker_location(raw_root, source.name, label)
    attempt = uuid.uuid4().hex

    if files.exists(spark, marker_path):
        marker = files.read_json(spark, marker_path)
        recover(store, marker)
        return result_of(marker, attempt)

    started = datetime.now(UTC)
    window = window_of(store, source, end)
    start_at, end_at = window.extract_start.astimezone(UTC), window.extract_end.astimezone(UTC)
    folder = f"{run_folder(raw_root, source.name, label)}/attempt_id={attempt}"
    rows, complete, rejects = Scan(records, True) if isinstance(records, DataFrame) else Scan(*records(start_at, end_at))
    inside = window_filter(conform.require_types(rows, schema), spec.event_time, start_at, end_at)
    carried = T.StructType([*schema.fields, *([inside.schema[page]] if page else [])])
    inside = shaped(inside, carried)
    written = landing.land_parts(inside, folder, spec.event_time, spec.key)
    rejected = None if rejects is None else land_rejects(rejects, folder, source.name, label)
    objects = materialise(landing.inventory(spark, folder, raw_root), "objects")
    totals = landing.verify_landing(objects, written)
    if written:
        landed = spark.read.parquet(folder)
        if page is None:
            checked = quality.null_key_count(landed, spec.key).select(
                F.lit(0).alias("page_number"),
                F.lit(written).alias("rows"),
                "null_keys",
                F.when(F.col("null_keys") > 0, "null_keys").alias("failed_check"),
            )
        else:
            checked = quality.raw_gate(landed, spec.key, page).withColumnRenamed(page, "page_number")
        quality.enforce_raw(checked)

    prefix = folder[len(raw_root) + 1 :]
    run = {"source": source.name, "logical_date": label, "run_id": run_id_of(source.name, label), "attempt_id": attempt}
    described = objects.select(*[F.lit(v).alias(k) for k, v in run.items()], "*")
    documents = control.build_manifests(described)
    manifest = control.manifest_json(F.lit(started), F.current_timestamp())
    documents.select(manifest.alias("value")).write.text(f"{folder}/{identity.MANIFEST_NAME}")
    payload = marker_payload(source.name, label, attempt, prefix, totals.objects, totals.rows, start_at, end_at, rejected)
    if not complete:
        return RawRun(source.name, label, run["run_id"], attempt, False, totals.rows, totals.objects, rejected)
    if not files.create_json(spark, marker_path, payload):
        payload = files.read_json(spark, marker_path)
    recover(store, payload)
    return result_of(payload, attempt)
