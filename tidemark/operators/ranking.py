"""Latest versions, row numbers and running totals without one-task sorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.spec import FeedSpec

# monotonically_increasing_id() holds the partition above this bit and the row
# number inside the partition below it.
_ROW_BITS = 33
# Rows that a range is meant to hold, and rows that it may hold at most.
RANGE_ROWS = 4_000_000
RANGE_MOST = min(1 << 28, (1 << _ROW_BITS) - 1)


def latest_per_key(
    df: DataFrame, spec: FeedSpec, by: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """Newest version of every key, null event times last.

    An aggregate rather than a window: each task first reduces its own rows to one
    per key, so a key with very many versions costs no more than any other.
    """
    row = F.struct(*[F.col(name) for name in (*spec.attributes, spec.event_time, *keep)])
    return (
        df.groupBy(*by, spec.key)
        .agg(F.max_by(row, spec.newest()).alias("_row"))
        .select(*by, spec.key, "_row.*")
    )


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Row placement is fixed from here on: a lost executor re-reads files instead of
    recomputing a range partitioning whose sampled bounds could differ.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _placed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, with their place recorded.

    The rows are counted first (on files without reading a column), and the number of
    ranges follows from that once RANGE_ROWS in each of the session's partitions do not
    hold them. Bounds are sampled, so a range may come out larger; one that exceeds
    RANGE_MOST is split by placing the rows again over twice as many ranges.
    """
    rows = df.count()
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = None if rows <= RANGE_ROWS * usual else -(-rows // RANGE_ROWS)
    while True:
        spread = df.repartitionByRange(*order) if ranges is None else df.repartitionByRange(ranges, *order)
        placed = materialise(
            spread.sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()), "placed"
        ).withColumn("_slice", F.shiftright("_place", _ROW_BITS).cast("int"))
        largest = placed.groupBy("_slice").count().agg(F.max("count")).first()[0] or 0
        if largest <= RANGE_MOST:
            return placed
        if ranges is not None and ranges >= rows:
            raise ValueError(f"{largest} rows are equal in their order, of {RANGE_MOST} that one task may number")
        ranges = min(rows, 2 * (ranges or usual))


def with_ordinal(
    df: DataFrame, order: Sequence[Column], name: str = "ordinal", start: int = 1
) -> DataFrame:
    """Global row number in ``order``, which must be a total order.

    Rows are range-partitioned, so ties on a leading column do not meet in one task
    as long as later columns tell them apart. Only the row count of each partition
    goes through a single task.
    """
    placed = _placed(df, order)
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    # One row per written partition, hence small whatever the data size.
    return (
        placed.join(F.broadcast(offsets), "_slice")
        .withColumn(name, F.col("_before") + inside + F.lit(start))
        .drop("_place", "_slice", "_before")
    )


def running_total(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str
) -> DataFrame:
    """Running sum of ``value`` over ``order`` within ``by``.

    The window runs inside range partitions; the totals of earlier partitions of the
    same group are added from a small table with one row per group and partition.
    """
    placed = _placed(df, [F.col(c) for c in (*by, *order)])
    inside = (
        Window.partitionBy(*by, "_slice")
        .orderBy("_place")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    earlier = (
        Window.partitionBy(*by)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        placed.groupBy(*by, "_slice")
        .agg(F.sum(value).alias("_sum"))
        .select(*by, "_slice", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        placed.withColumn("_inside", F.sum(value).over(inside))
        .join(offsets, [*by, "_slice"])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_place", "_slice", "_before", "_inside")
    )


def surrogate_keys(new_keys: DataFrame, key: str, surrogate: str, start: int) -> DataFrame:
    """Number new business keys upwards from ``start``, in key order.

    Deterministic, so a replay after a failure gives the same numbers. ``new_keys``
    must hold each key once.
    """
    return with_ordinal(new_keys.select(key), [F.col(key)], surrogate, start)


