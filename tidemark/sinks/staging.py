"""Staging rows: lineage columns and replacement by batch and object."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OBJECT_KEY = ("batch_date", "raw_object_key")


def with_lineage(
    raw: DataFrame, batch_date: date | Column, loaded_at: datetime | Column, root: str | None = None
) -> DataFrame:
    """Add batch date, object key and load time.

    Without a ``raw_object_key`` column the key is the path of the file each row was
    read from, relative to ``root``.
    """
    if "raw_object_key" not in raw.columns:
        path = F.col("_metadata.file_path")
        if root is not None:
            path = F.substring_index(path, root.rstrip("/") + "/", -1)
        raw = raw.withColumn("raw_object_key", path)
    return raw.withColumns(
        {
            "batch_date": batch_date if isinstance(batch_date, Column) else F.lit(batch_date),
            "loaded_at": loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at),
        }
    )


def replace_objects(staged: DataFrame, fresh: DataFrame, listed: DataFrame) -> DataFrame:
    """Staging after reloading the listed objects.

    Rows of a listed (batch_date, raw_object_key) go, those of ``fresh`` come; an
    object that is listed but has no rows just disappears. Objects that are not listed
    stay, even in the same batch.
    """
    kept = staged.join(listed.select(*OBJECT_KEY), list(OBJECT_KEY), "left_anti")
    return kept.unionByName(fresh)


def overwrite_objects(staged_path: str, fresh: DataFrame) -> None:
    """The same in place, for a table partitioned by batch and object: only the
    partitions present in ``fresh`` are replaced. Listed objects without rows have to
    be removed with ``replace_objects``.
    """
    (
        fresh.hint("rebalance", *OBJECT_KEY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*OBJECT_KEY)
        .parquet(staged_path)
    )
