"""Joins to tables of one row per key, and connected components, for the operators here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# Rows of two or three numbers that are sent to all tasks: 32 MB at most.
BROADCAST_ROWS = 1_000_000


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written to the shared folder and read again."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def narrow_join(rows: DataFrame, by_key: DataFrame, on, how: str = "inner", most: int | None = None) -> DataFrame:
    """Join to a table of a few numbers per key: broadcast if it is counted as small.

    ``most`` is a known bound of its rows, which saves counting a stored table. Otherwise both sides are shuffled by the key and runtime splitting takes hot keys
    apart, which works as the other side has each key once.
    """
    size = by_key.count() if most is None else most
    return rows.join(F.broadcast(by_key) if size <= BROADCAST_ROWS else by_key, on, how)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes with an edge (a, b); a component is its least node.

    Alternates two steps until nothing changes: every node links its larger neighbours to
    the least node it knows, then every node links its smaller neighbours and itself to
    the least of these. Rounds grow with the logarithm of the nodes.
    """
    state = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = now
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # A node has at least one edge, so there are at most twice as many nodes.
        nodes = 2 * now[0]
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = narrow_join(both, least, "a", most=nodes).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = narrow_join(large, least, "a", most=nodes).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        state = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
