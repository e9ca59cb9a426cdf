"""Equi-joins that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import materialise

# A side with at most this many rows is broadcast; callers select the columns they need.
BROADCAST_ROWS = 100_000
# A key with more rows than this is split over several tasks.
HOT_ROWS = 2_000_000


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows.

    A distributed count, which on files reads no column; a limit would instead send
    that many rows of every partition to one task.
    """
    return rows > 0 and df.count() <= rows


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys of ``df`` with more than ``hot_rows`` rows and their number of splits.

    Reads the key columns only, and combines before its shuffle. There are fewer such
    keys than rows over ``hot_rows``.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > hot_rows)
        .select(*keys, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_splits"))
    )


def stored_hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``hot_keys`` as a written table, so that joins to it know its size beforehand."""
    return materialise(hot_keys(df, keys, hot_rows), "hot")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    spread: Sequence[str],
    hot_from: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    small: bool | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``left.join(right, keys, how)`` for an inner or left join with hot left keys.

    A right side of at most ``BROADCAST_ROWS`` rows is broadcast and nothing is
    shuffled; ``small`` tells whether it is, and without it the rows are counted.
    Otherwise left rows of a hot key are spread over its splits by a hash of
    the ``spread`` columns, and the matching right rows are repeated once per split;
    all other keys join as usual. Left rows with a null key match nothing and are
    spread as well. ``hot_from`` may be a cheaper frame than ``left`` to count keys on,
    such as its base table, and ``hot`` the ``stored_hot_keys`` found on it before. They
    are broadcast unless there are very many, so that only the join itself shuffles.
    No row is dropped and none is added.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join does inner and left joins only")
    keys = list(keys)
    if fits(right) if small is None else small:
        return left.join(F.broadcast(right), keys, how)
    if hot is None:
        hot = stored_hot_keys(hot_from if hot_from is not None else left, keys, hot_rows)
    hot = F.broadcast(hot) if fits(hot) else hot
    place = F.xxhash64(*[F.col(name) for name in spread])
    null_key = F.lit(False)
    for name in keys:
        null_key = null_key | F.col(name).isNull()
    if how == "inner":
        left = left.filter(~null_key)
    salted_left = left.join(hot, keys, "left").withColumn(
        "_salt",
        F.when(null_key, F.pmod(place, F.lit((1 << 31) - 1)))
        .when(F.col("_splits").isNotNull(), F.pmod(place, F.col("_splits").cast("long")))
        .otherwise(F.lit(0))
        .cast("int"),
    ).drop("_splits")
    salted_right = right.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1))
    ).drop("_splits")
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")
