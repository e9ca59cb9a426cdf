"""Blocking quality gates and their metrics.

Gates give metric rows in long form; ``enforce`` raises on the failed ones. Every
count combines before its shuffle, so a batch or page of any size is no hot spot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import GateError
from tidemark.operators.joins import HOT_ROWS, skew_join
from tidemark.schema import UNIQUE_KEYS
from tidemark.spec import FeedSpec

METRIC_KEY = UNIQUE_KEYS["dq_metrics"]

# Message per metric, in the order in which failures are reported. Fixed texts that
# callers match: "row-count mismatch", "Mart dimension reconciliation failed", "Mart
# fact reconciliation failed".
FAILURES = {
    "row_count": "Staging row-count mismatch: {metric_value} rows stored, {expected_value} in the manifest",
    "null_code_count": "Staging null keys: {metric_value} rows have no key.",
    "missing_dimension_count": (
        "Mart dimension reconciliation failed: {metric_value} staged rows lack their dimension row"
    ),
    "missing_fact_count": (
        "Mart fact reconciliation failed: {metric_value} staged events lack their fact"
    ),
}


def null_key_count(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count_if(F.col(key).isNull()).alias("null_keys"))


def duplicate_keys(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Non-null keys that appear more than once inside a group, with their count."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(*by, key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


def raw_gate(df: DataFrame, key: str, page: str = "page_number") -> DataFrame:
    """Per page: rows, null keys, distinct keys and the first failed check.

    The same key on two pages is legal. Rows are first reduced to one per page and
    key, so the exact distinct count needs no large set anywhere.
    """
    per_key = df.groupBy(page, key).agg(F.count(F.lit(1)).alias("_rows"))
    return (
        per_key.groupBy(page)
        .agg(
            F.sum("_rows").alias("rows"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_rows"))), F.lit(0)).alias("null_keys"),
            F.count(key).alias("distinct_keys"),
        )
        .withColumn(
            "failed_check",
            F.when(F.col("null_keys") > 0, "null_keys").when(
                F.col("distinct_keys") != F.col("rows"), "duplicate_keys"
            ),
        )
    )


def enforce_raw(checked: DataFrame) -> int:
    """Rows that passed; raises on an empty batch or a failed page."""
    first = F.min(F.when(F.col("failed_check").isNotNull(), F.struct("page_number", "failed_check", "null_keys")))
    row = checked.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), first.alias("bad")).first()
    if row.rows == 0:
        raise GateError("nothing was landed")
    if row.bad and row.bad.failed_check == "null_keys":
        raise GateError(f"Found {row.bad.null_keys} records with null keys on page {row.bad.page_number}.")
    if row.bad:
        raise GateError(f"Duplicate keys detected within page {row.bad.page_number}.")
    return row.rows


def metric_rows(
    counts: DataFrame, source: str | Column, layer: str, expected: dict[str, Column]
) -> DataFrame:
    """One metric row per batch and count column, in long form.

    ``expected`` maps each metric to the value at which it passes.
    """
    source = F.lit(source) if isinstance(source, str) else source
    cells = []
    for name, target in expected.items():
        cells += [F.lit(name), F.col(name).cast("long"), target.cast("long")]
    return counts.select(
        source.alias("source_name"),
        F.lit(layer).alias("pipeline_layer"),
        "batch_date",
        F.stack(F.lit(len(expected)), *cells).alias("metric_name", "metric_value", "expected_value"),
    ).select(
        "source_name",
        "pipeline_layer",
        "batch_date",
        "metric_name",
        "metric_value",
        (F.col("metric_value") == F.col("expected_value")).alias("passed"),
        "expected_value",
    )


def filtered_counts(staged: DataFrame, key: str, by: Sequence[str] = ("batch_date",)) -> DataFrame:
    return staged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(key).isNull()).alias("null_code_count"),
    )


def staging_gate(staged: DataFrame, expected: DataFrame, key: str, source: str) -> DataFrame:
    """Metrics per expected batch. ``expected``: batch_date, expected_rows."""
    counts = expected.join(filtered_counts(staged, key), "batch_date", "left").select(
        "batch_date",
        "expected_rows",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce("null_code_count", F.lit(0)).alias("null_code_count"),
    )
    return metric_rows(
        counts,
        source,
        "staging",
        {"row_count": F.col("expected_rows"), "null_code_count": F.lit(0)},
    )


def mart_counts(
    staged: DataFrame,
    dimension: DataFrame,
    facts: DataFrame,
    spec: FeedSpec,
    hot_rows: int = HOT_ROWS,
    small: bool | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Per batch: staging rows without a dimension row, and staging events without a
    fact row.

    Staging shrinks to one row per batch, key and event time before the joins.
    ``small`` tells whether the dimension can be broadcast, ``hot`` the hot keys of
    staging if these are known (see ``skew_join``).
    """
    key, time = spec.key, spec.event_time
    events = staged.groupBy("batch_date", key, time).agg(F.count(F.lit(1)).alias("_rows"))
    keyed = skew_join(
        events,
        dimension.select(key, spec.surrogate),
        [key],
        "left",
        [time, "batch_date"],
        staged,
        hot_rows,
        small,
        hot,
    )
    # Surrogates are positive: rows without one get a negative stand-in, which matches
    # nothing and spreads them over the tasks of the join.
    missing = F.col(spec.surrogate).isNull()
    stand_in = -F.pmod(F.xxhash64(key, time), F.lit(1 << 20)) - 1
    known = facts.select(
        F.col(spec.surrogate).alias("_fact_key"), F.col(spec.target_time).alias(time), F.lit(True).alias("_fact")
    )
    matched = keyed.select(
        "batch_date",
        time,
        "_rows",
        missing.alias("_no_dim"),
        F.coalesce(F.col(spec.surrogate), stand_in).alias("_fact_key"),
    ).join(known, ["_fact_key", time], "left")
    no_fact = F.col(time).isNotNull() & F.col("_fact").isNull()
    return matched.groupBy("batch_date").agg(
        F.sum(F.when(F.col("_no_dim"), F.col("_rows")).otherwise(0)).alias("missing_dimension_count"),
        F.sum(F.when(no_fact, F.col("_rows")).otherwise(0)).alias("missing_fact_count"),
    )


def mart_gate(
    staged: DataFrame,
    dimension: DataFrame,
    facts: DataFrame,
    spec: FeedSpec,
    source: str,
    hot_rows: int = HOT_ROWS,
    small: bool | None = None,
    batches: DataFrame | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Metrics per batch; with ``batches`` (batch_date) an empty one has metrics too."""
    counts = mart_counts(staged, dimension, facts, spec, hot_rows, small, hot)
    if batches is not None:
        counts = batches.join(counts, "batch_date", "left").na.fill(0)
    return metric_rows(
        counts,
        source,
        "mart",
        {"missing_dimension_count": F.lit(0), "missing_fact_count": F.lit(0)},
    )


def gate_outcomes(metrics: DataFrame) -> DataFrame:
    """Per source, layer and batch: failed checks and the one that would be reported.

    The set form of ``enforce``: a batch with a failed check is blocked, whatever its other
    checks say, and checks are reported in the order of FAILURES, others after them.
    """
    order = F.create_map(*[F.lit(x) for name, rank in zip(FAILURES, range(len(FAILURES)), strict=True) for x in (name, rank)])
    rank = F.coalesce(F.try_element_at(order, F.col("metric_name")), F.lit(len(FAILURES)))
    failed = F.when(~F.col("passed"), F.struct(rank.alias("rank"), F.col("metric_name").alias("name")))
    return metrics.groupBy("source_name", "pipeline_layer", "batch_date").agg(
        F.count_if(~F.col("passed")).alias("failed_checks"), F.min(failed)["name"].alias("blocked_by")
    )


def enforce(metrics: DataFrame) -> list:
    """Metric rows of a passed gate; raises ``GateError`` with them otherwise.

    A gate has two metrics per batch, so they may come to the driver.
    """
    rows = sorted(metrics.collect(), key=lambda row: (row.batch_date, row.metric_name))
    failed = {row.metric_name: row for row in reversed(rows) if not row.passed}
    for name, message in FAILURES.items():
        if name in failed:
            raise GateError(message.format(**failed[name].asDict()), rows)
    if failed:
        raise GateError(f"Failed checks: {', '.join(sorted(failed))}.", rows)
    return rows


def upsert_metrics(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored metrics with those of ``fresh`` added or replaced, by metric key."""
    return stored.join(fresh.select(*METRIC_KEY), list(METRIC_KEY), "left_anti").unionByName(fresh)


def account_rows(counts: DataFrame, source: str, layer: str, names: Sequence[str]) -> DataFrame:
    """Metric rows of counts that are kept for the record: they expect nothing and pass."""
    rows = metric_rows(counts, source, layer, {name: F.col(name) for name in names})
    return rows.withColumns({"passed": F.lit(True), "expected_value": F.lit(None).cast("long")})


def add_metrics(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored metrics with the values of ``fresh`` added to those of the same key."""
    kept = stored.unionByName(fresh).groupBy(*METRIC_KEY).agg(
        F.sum("metric_value").alias("metric_value"),
        F.bool_and("passed").alias("passed"),
        F.max("expected_value").alias("expected_value"),
        F.max("recorded_at").alias("recorded_at"),
    )
    return kept.select(*stored.columns)


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count of each required column, from one pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    cells = [part for name in columns for part in (F.lit(name), F.col(name))]
    return counts.select(
        F.stack(F.lit(len(columns)), *cells).alias("column_name", "null_rows")
    )


def enforce_table(df: DataFrame, name: str, keys: Sequence[str], required: Sequence[str]) -> None:
    """Unique and not-null rules of a table, checked before it is published."""
    nulls = [row for row in not_null_violations(df, required).collect() if row.null_rows]
    if nulls:
        raise GateError(f"{name}: null in required column {nulls[0].column_name}.")
    if keys:
        bad = unique_violations(df, keys).limit(1).collect()
        if bad:
            raise GateError(f"{name}: key {bad[0].asDict()} is not unique.")
