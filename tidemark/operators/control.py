"""Runs, manifests, commits and watermarks as tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import GateError, WatermarkError
from tidemark.functions import identity, times

RUN_COLUMNS = ("source", "logical_date", "run_id", "attempt_id")

# A manifest document lists at most this many part numbers; larger attempts have
# several documents with the same totals.
PARTS_PER_DOCUMENT = 1_000

MANIFEST_VERSION = 1
MARKER_VERSION = 2


def with_run_id(df: DataFrame, source: str = "source", logical_date: str = "logical_date") -> DataFrame:
    return df.withColumn("run_id", identity.run_id(source, logical_date))


def run_totals(objects: DataFrame, by: Sequence[str] = RUN_COLUMNS) -> DataFrame:
    return objects.groupBy(*by).agg(
        F.count(F.lit(1)).alias("object_count"), F.sum("row_count").alias("row_count")
    )


def build_manifests(objects: DataFrame, part: str = "part_number") -> DataFrame:
    """Manifest documents of every attempt.

    ``objects``: run columns, part number, object_key, row_count, size_bytes. The list
    of a document is bounded because it covers a bounded range of part numbers.
    """
    documents = (
        objects.withColumn("document", F.floor(F.col(part) / PARTS_PER_DOCUMENT).cast("int"))
        .groupBy(*RUN_COLUMNS, "document")
        .agg(
            F.array_sort(F.collect_list(F.struct("object_key", "row_count", "size_bytes"))).alias("objects")
        )
    )
    return documents.join(run_totals(objects), list(RUN_COLUMNS)).withColumn(
        "schema_version", F.lit(MANIFEST_VERSION)
    )


def manifest_json(started_at: Column, completed_at: Column) -> Column:
    """A manifest document as JSON text with its keys in name order."""
    fields = {
        "attempt_id": F.col("attempt_id"),
        "completed_at": times.iso_text(completed_at),
        "document": F.col("document"),
        "logical_date": F.col("logical_date").cast("string"),
        "object_count": F.col("object_count"),
        "objects": F.transform(
            "objects",
            lambda o: F.struct(
                o["object_key"].alias("object_key"),
                o["row_count"].alias("row_count"),
                o["size_bytes"].alias("size_bytes"),
            ),
        ),
        "row_count": F.col("row_count"),
        "run_id": F.col("run_id"),
        "schema_version": F.col("schema_version"),
        "source": F.col("source"),
        "started_at": times.iso_text(started_at),
    }
    return F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()]))


def manifest_objects(manifests: DataFrame) -> DataFrame:
    """One row per listed object."""
    return manifests.select(*RUN_COLUMNS, F.explode("objects").alias("_object")).select(
        *RUN_COLUMNS, "_object.*"
    )


def reconcile_manifests(manifests: DataFrame) -> DataFrame:
    """Declared and listed rows of every attempt, and whether they agree."""
    listed = F.aggregate("objects", F.lit(0).cast("long"), lambda total, o: total + o["row_count"])
    return (
        manifests.groupBy(*RUN_COLUMNS)
        .agg(
            F.max("row_count").alias("declared_rows"),
            F.coalesce(F.sum(listed), F.lit(0)).alias("listed_rows"),
        )
        .withColumn("matches", F.col("declared_rows") == F.col("listed_rows"))
    )


def require_reconciled(checked: DataFrame) -> None:
    bad = checked.filter(~F.col("matches")).limit(1).collect()
    if bad:
        row = bad[0]
        raise GateError(
            # Fixed opening that callers match.
            f"Raw manifest row-count mismatch in run {row.run_id}: "
            f"{row.listed_rows} rows in its objects, {row.declared_rows} in its header"
        )


def commit_records(totals: DataFrame, windows: DataFrame, committed_at: Column) -> DataFrame:
    """Commit record of each attempt: who, what, which window, next watermark.

    ``totals``: run columns, object_count, row_count. ``windows``: source_name,
    logical_date, extract_start, extract_end, next_watermark.
    """
    joined = totals.join(
        windows.withColumnRenamed("source_name", "source"), ["source", "logical_date"]
    )
    prefix = identity.attempt_prefix("source", "logical_date", "run_id", "attempt_id")
    return joined.select(
        F.lit(MARKER_VERSION).alias("schema_version"),
        *RUN_COLUMNS,
        identity.manifest_key(prefix).alias("manifest_key"),
        "object_count",
        "row_count",
        "extract_start",
        "extract_end",
        "next_watermark",
        committed_at.alias("committed_at"),
    )


def winning_attempts(attempts: DataFrame) -> DataFrame:
    """First committer of every run; an equal instant is decided by attempt id."""
    carried = [name for name in attempts.columns if name != "run_id"]
    return (
        attempts.groupBy("run_id")
        .agg(F.min_by(F.struct(*carried), F.struct("committed_at", "attempt_id")).alias("_win"))
        .select("run_id", "_win.*")
    )


def committed_objects(commits: DataFrame, manifests: DataFrame) -> DataFrame:
    """Objects of winning attempts only; nothing is found by listing folders."""
    winners = commits.select("run_id", "attempt_id")
    return manifest_objects(manifests.join(winners, ["run_id", "attempt_id"], "left_semi"))


def pending_runs(wanted: DataFrame, commits: DataFrame) -> DataFrame:
    return wanted.join(commits.select("run_id"), "run_id", "left_anti")


def done_runs(wanted: DataFrame, commits: DataFrame) -> DataFrame:
    return wanted.join(commits.select("run_id"), "run_id", "left_semi")


def advance_watermarks(stored: DataFrame, offered: DataFrame, now: datetime | Column) -> DataFrame:
    """The watermark table after offering new values, with ``offered`` and ``changed``.

    A value is taken when the source is new or the value is strictly later.
    ``offered``: source_name, watermark_ts, run_id, one row per source.
    """
    stamp = now if isinstance(now, Column) else F.lit(now)
    new = offered.select("source_name", F.struct("watermark_ts", "run_id").alias("_new"))
    joined = stored.join(new, "source_name", "full_outer")
    changed = F.col("_new").isNotNull() & (
        F.col("watermark_ts").isNull()
        | F.coalesce(F.col("_new.watermark_ts") > F.col("watermark_ts"), F.lit(False))
    )
    take = F.col("changed")
    return joined.withColumn("changed", changed).select(
        "source_name",
        F.when(take, F.col("_new.watermark_ts")).otherwise(F.col("watermark_ts")).alias("watermark_ts"),
        F.when(take, stamp).otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(take, F.col("_new.run_id")).otherwise(F.col("run_id")).alias("run_id"),
        F.col("_new").isNotNull().alias("offered"),
        "changed",
    )


def require_advanced(result: DataFrame) -> DataFrame:
    """Raises when an offered value was not later than the stored one."""
    stuck = result.filter(F.col("offered") & ~F.col("changed")).limit(20).collect()
    if stuck:
        names = ", ".join(row.source_name for row in stuck)
        raise WatermarkError(f"Watermark was not advanced, the offered value is not later: {names}.")
    return result


def watermarks_from_commits(commits: DataFrame) -> DataFrame:
    """Highest committed watermark of each source, with the run that set it."""
    return (
        commits.groupBy("source")
        .agg(
            F.max_by(
                F.struct(F.col("next_watermark").alias("watermark_ts"), "run_id"),
                F.struct("next_watermark", "run_id"),
            ).alias("_top")
        )
        .select(F.col("source").alias("source_name"), "_top.*")
    )


def recover_watermarks(stored: DataFrame, commits: DataFrame, now: datetime | Column) -> DataFrame:
    """Bring watermarks up to the commits without reading any source again."""
    return advance_watermarks(stored, watermarks_from_commits(commits), now)
