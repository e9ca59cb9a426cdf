"""Parquet scans and filters that reach them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import RAW, RAW_COLUMNS, relaxed


def project_raw(df: DataFrame, columns: Sequence[str] = tuple(RAW_COLUMNS)) -> DataFrame:
    return df.select(*columns)


def with_category(df: DataFrame, tag: str, column: str = "categories_tags_en") -> DataFrame:
    return df.filter(F.array_contains(column, tag))


def scan_raw(spark: SparkSession, *paths: str, schema: T.StructType = RAW) -> DataFrame:
    """Named Parquet objects in one scan, with the declared schema."""
    return spark.read.schema(relaxed(schema)).parquet(*paths)


def staging_batch(staged: DataFrame, *batch_dates: date) -> DataFrame:
    """Rows of the given batches; on a table partitioned by date only these are read."""
    return staged.filter(F.col("batch_date").isin([F.lit(d) for d in batch_dates]))


def events_only(staged: DataFrame, event_time: str) -> DataFrame:
    return staged.filter(F.col(event_time).isNotNull())
