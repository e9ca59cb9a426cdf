"""Daily chain, and the mart from many staged batches."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from tidemark.plans.mart_load import MartLoad, load_mart, merge_batch
from tidemark.plans.raw_load import RawRun, Reader, Source, load_raw
from tidemark.plans.staging_load import load_staging
from tidemark.sinks.tables import TableStore
from tidemark.spec import FeedSpec


@dataclass(frozen=True)
class DailyLoad:
    raw: RawRun
    staged_rows: int
    mart: MartLoad


def load_day(
    store: TableStore,
    raw_root: str,
    source: Source,
    batch_end: datetime,
    records: DataFrame | Reader,
    page: str | None = None,
) -> DailyLoad:
    """Raw, staging and mart for one batch end; scheduling stays with the caller."""
    raw = load_raw(store, raw_root, source, batch_end, records, page)
    staged = load_staging(store, raw_root, source, raw.logical_date)
    mart = load_mart(store, raw.logical_date, source.spec, source.name)
    return DailyLoad(raw, staged, mart)


def backfill_mart(store: TableStore, staged: DataFrame, spec: FeedSpec, source: str) -> MartLoad:
    """Bring many staged batches into the mart, empty or filled, in one merge.

    Gives the tables that loading the batches one by one in ascending order would.
    """
    return merge_batch(store, staged, None, spec, source)
