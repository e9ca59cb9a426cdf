"""Mart load: merge the dimension, insert new facts, reconcile, publish."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.errors import GateError
from tidemark.functions.times import DAY_SECONDS
from tidemark.operators import merge, quality
from tidemark.operators.joins import BROADCAST_ROWS, HOT_ROWS, stored_hot_keys
from tidemark.operators.ranking import latest_per_key, materialise, surrogate_keys
from tidemark.operators.windows import LATE_COUNTS, late_counts
from tidemark.plans.staging_load import slot_of, write_metrics
from tidemark.session import releases_scratch, setting
from tidemark.schema import required_columns, unique_keys
from tidemark.sinks.tables import BUCKETS, DAY, Snapshot, TableStore, bucket_of, day_of
from tidemark.spec import FeedSpec

# Event days of a batch that are broadcast at most: one number each.
DAYS_MOST = 100_000

# Joins of facts whose shuffled partitions are all at most this large are by hash, others
# by sorting: rows in the order of two columns are sorted by comparison.
HASHED_BYTES = "64m"
HASHED = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"

# Store properties holding the highest keys handed out, so that a load need not look
# through the whole tables for them.
DIMENSION_HIGH = "highest-key:dimension"
FACT_HIGH = "highest-key:fact"


@dataclass(frozen=True)
class MartLoad:
    dimension_changed: int
    facts_inserted: int


def insert_facts(
    store: TableStore,
    base: Snapshot,
    staged: DataFrame,
    dimension: DataFrame,
    spec: FeedSpec,
    now: datetime,
    between: tuple[int, int] | None = None,
    hot_rows: int = HOT_ROWS,
    small: bool | None = None,
    by_batch: bool = False,
    days: DataFrame | None = None,
    hot: DataFrame | None = None,
) -> tuple[dict[str, list[str]], int, int]:
    """Write the facts a batch adds to a new folder, or to one of each batch.

    ``between`` are the least and greatest event time of the batch, ``days`` its event
    days (see ``known_facts``), ``hot`` its hot keys (see ``skew_join``). Returns the folders by
    batch (or under ""), the number of facts and the highest key handed out so far.
    """
    known = known_facts(store, base, spec, between, days)
    events = merge.lookup_surrogates(
        merge.distinct_events(staged, spec), dimension, spec, "inner", staged, hot_rows, small, hot
    )
    fresh = merge.new_facts(events, known, spec, between)
    # Unique and increasing, with gaps: the write computes each number once per row, and
    # a retried task replaces its own output. With 10,000 partitions per load the range
    # of a long lasts for 100,000 loads.
    start = int(base.properties.get(FACT_HIGH, "0")) + 1
    numbered = fresh.withColumn(
        spec.fact_key, F.monotonically_increasing_id() + F.lit(start)
    ).withColumn("loaded_at", F.lit(now))
    parts = store.write_parts("fact", numbered, "batch_date", gather=True) if by_batch else {"": [store.write("fact", numbered)]}
    row = store.open("fact", folders_of(parts)).agg(F.count(F.lit(1)), F.max(spec.fact_key)).first()
    return parts, row[0], row[1] or start - 1


def event_days(staged: DataFrame, spec: FeedSpec) -> DataFrame:
    """The days that a batch has events of, written once."""
    timed = staged.where(F.col(spec.event_time).isNotNull())
    return materialise(timed.select(day_of(spec.event_time, spec.fact_days).alias(DAY)).distinct(), "days")


def known_facts(
    store: TableStore, base: Snapshot, spec: FeedSpec, between: tuple[int, int] | None, days: DataFrame | None
) -> DataFrame:
    """Stored facts that a batch could hold again.

    The bounds prune folders of days and reach the scan of the rest. Of the days between
    them only those of the batch are opened: their list is broadcast, and the scan is
    pruned by it when it starts. A list of more than DAYS_MOST days (some 270 years) is
    left aside, which changes what is read and nothing else.
    """
    facts = store.read("fact", snapshot=base, with_day=True)
    if between is None:
        return facts.drop(DAY)
    step = spec.fact_days
    first, last = (t // (step * DAY_SECONDS) * step for t in between)
    inside = F.col(DAY).between(first, last)
    facts = facts.where(inside & F.col(spec.target_time).between(*between))
    if days is not None and days.count() <= DAYS_MOST:
        facts = facts.join(F.broadcast(days.where(inside)), DAY, "left_semi")
    return facts.drop(DAY)


def folders_of(parts: dict[str, list[str]]) -> list[str]:
    return [path for paths in parts.values() for path in paths]


def touched_buckets(latest: DataFrame, key: str, buckets: int) -> list[str]:
    """Dimension buckets the keys of a batch fall into; at most ``buckets`` values."""
    if buckets == 1:
        return ["0"]
    rows = latest.select(bucket_of(key, buckets).alias("bucket")).distinct().collect()
    return [str(row.bucket) for row in rows]


def check_mart(store: TableStore, dimension: DataFrame, facts: DataFrame, spec: FeedSpec) -> None:
    """Rules of the tables on what a load wrote, before anything of it is visible.

    Facts of earlier loads cannot clash with new ones: those were anti-joined.
    """
    for name, rows in (("dimension", dimension), ("fact", facts)):
        quality.enforce_table(rows, name, unique_keys(spec, name), required_columns(store.schemas[name]))
    lost = merge.orphans(facts, dimension, spec.surrogate).limit(1).collect()
    if lost:
        raise GateError(f"fact: {spec.surrogate} {lost[0][0]} is not in the dimension.")


@releases_scratch
def merge_batch(
    store: TableStore,
    staged: DataFrame,
    label: str | None,
    spec: FeedSpec,
    source: str,
    properties: dict[str, str] | None = None,
    hot_rows: int = HOT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
    batches: DataFrame | None = None,
    account: str | None = None,
) -> MartLoad:
    """Bring staged rows into the mart: dimension first, then facts, gate and publish.

    Without a ``label`` the rows are of many batches, and the mart, empty or filled, ends
    as if these had been loaded one by one in ascending order: each key's version that
    would be left is merged once, each event counts for its first batch, and the facts of
    every batch are stored under its own date. With ``account`` the counts of
    ``late_counts`` are added up over loads, as metrics of the layer of that name.
    """
    now = datetime.now(UTC)
    base = store.snapshot()
    if label is None:
        versions = merge.dimension_closed_form(staged, spec).withColumnRenamed(spec.target_time, spec.event_time)
    else:
        versions = latest_per_key(staged, spec)
    latest = materialise(versions, "latest")
    buckets = int(base.properties.get(BUCKETS, "1"))
    dimension = store.read("dimension", touched_buckets(latest, spec.key, buckets), base)
    key_start = int(base.properties.get(DIMENSION_HIGH, "0")) + 1
    new_keys = surrogate_keys(
        merge.unknown_keys(latest, dimension, spec.key),
        spec.key,
        spec.surrogate,
        key_start,
    )
    merged = merge.merge_type1(dimension, latest, spec, now, new_keys)
    dim_slots = store.write_buckets("dimension", merged, spec.key, buckets, gather=True)
    written = store.open("dimension", folders_of(dim_slots))
    size, changed, highest = written.agg(
        F.count(F.lit(1)),
        F.count_if(F.col("updated_at") == F.lit(now)),
        F.coalesce(F.max(spec.surrogate), F.lit(0)),
    ).first()
    small_dimension = size <= broadcast_rows
    # Found once for the facts and the gate.
    hot = None if small_dimension else stored_hot_keys(staged, [spec.key], hot_rows)

    bounds = staged.agg(F.min(spec.event_time), F.max(spec.event_time)).first()
    between = None if bounds[0] is None else tuple(bounds)
    days = event_days(staged, spec) if base.slots.get("fact") else None
    with setting(store.spark, HASHED, HASHED_BYTES):
        parts, inserted, highest_fact = insert_facts(
            store, base, staged, written, spec, now, between, hot_rows, small_dimension, label is None, days, hot
        )
    fresh_facts = store.open("fact", folders_of(parts))
    fact_slots = {}
    for batch, folders in parts.items() if inserted else ():
        slot = slot_of(source, batch) if label is None else label
        fact_slots[slot] = store.joined("fact", [*base.slots.get("fact", {}).get(slot, []), *folders])
    # Facts outside the batch's days cannot match; the scan skips them.
    all_facts = known_facts(store, base, spec, between, days).unionByName(fresh_facts)
    gate = quality.mart_gate(staged, written, all_facts, spec, source, hot_rows, small_dimension, batches, hot)
    with setting(store.spark, HASHED, HASHED_BYTES):
        rows = quality.enforce(gate)
    check_mart(store, written, fresh_facts, spec)
    metrics = write_metrics(store, base, "mart", source, rows, now)
    if account is not None:
        slot = f"{account}/{source}"
        counted = quality.account_rows(late_counts(staged, fresh_facts, spec), source, account, LATE_COUNTS)
        counted = counted.withColumn("recorded_at", F.lit(now))
        added = quality.add_metrics(store.read("dq_metrics", [slot], base), counted)
        metrics["dq_metrics"][slot] = [store.write("dq_metrics", added)]
    store.publish(
        base,
        {"dimension": dim_slots, "fact": fact_slots, **metrics},
        {DIMENSION_HIGH: str(max(highest, key_start - 1)), FACT_HIGH: str(highest_fact), **(properties or {})},
    )
    return MartLoad(changed, inserted)


def load_mart(store: TableStore, batch_date: date, spec: FeedSpec, source: str) -> MartLoad:
    """Load one staged batch; running it again changes nothing."""
    label = slot_of(source, batch_date)
    batches = store.spark.range(1).select(F.lit(batch_date).alias("batch_date"))
    return merge_batch(store, store.read("staging", [label]), label, spec, source, batches=batches)
