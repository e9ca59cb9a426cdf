"""Landing of raw Parquet parts and their inventory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import GateError


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Snappy Parquet; with partition columns each value gets files of even size."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.option("compression", "snappy").partitionBy(*partition_by).parquet(path)


def land_parts(df: DataFrame, path: str, event_time: str, key: str) -> int:
    """Write parts sorted by event time and return the rows written.

    A window usually takes a little from many input partitions, so its rows are first
    packed into partitions of even size, whatever their times or keys; no sampling pass
    over the source is needed for that. Sorting inside a part lets later reads skip row
    groups; by the time alone it is a radix sort, while ``key`` as a second column would
    make it compare rows. The rows are counted where they are written.
    """
    written = Observation()
    (
        df.hint("rebalance")
        .sortWithinPartitions(event_time)
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.option("compression", "snappy")
        .parquet(path)
    )
    return written.get["rows"]


def land_batches(df: DataFrame, path: str, by: Sequence[str], event_time: str, key: str) -> int:
    """Write the parts of many batches in one job and return the rows written.

    ``by`` names the columns whose values are the folders of a batch. Only folders that
    the job has rows for are written or replaced, each as a whole. A batch gets as many
    parts as its size asks for, sorted like those of ``land_parts``.
    """
    written = Observation()
    (
        df.hint("rebalance", *by)
        .sortWithinPartitions(*by, event_time, key)
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*by)
        .parquet(path)
    )
    return written.get["rows"]


def inventory(spark: SparkSession, path: str | Sequence[str], root: str | None = None) -> DataFrame:
    """Landed objects with key, part number, rows and bytes; empty files do not count.

    ``path`` is a folder or several folders.

    Reads no data column. Keys are relative to ``root`` when it is given.
    """
    location = F.col("file_path")
    key = F.substring_index(location, root.rstrip("/") + "/", -1) if root else location
    return (
        spark.read.parquet(*([path] if isinstance(path, str) else path))
        .groupBy(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("size_bytes"),
        )
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(
            key.alias("object_key"),
            F.regexp_extract("file_path", r"/part-(\d+)[^/]*$", 1).cast("int").alias("part_number"),
            "row_count",
            "size_bytes",
        )
    )


def verify_landing(objects: DataFrame, written_rows: int) -> Row:
    """Everything written must be readable again; returns the numbers of objects and rows."""
    found = objects.agg(
        F.count(F.lit(1)).alias("objects"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows")
    ).first()
    if found.rows != written_rows:
        raise GateError(f"Landing verification failed: wrote {written_rows} rows, can read {found.rows}.")
    return found
