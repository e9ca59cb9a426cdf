"""Exact top-k by inner product in three phases with a uniform threshold.

A vector's components are dealt to lists; a list knows the part of every inner product
that its components make. Phase 1 gathers the best k entries of each list and sums these
candidates' parts exactly: the k-th best total is a safe cutoff c, since k vectors reach
it. Of m parts of a total of at least c, one is at least c / m, so in phase 2 every list
sends what reaches that threshold, and nothing else can be in the result. Totals known
from all lists raise the cutoff; a vector whose missing parts, each below the threshold,
cannot lift it to the cutoff is dropped. Phase 3 resolves the rest exactly, from the
vectors themselves.

Queries travel in blocks of bounded size to the tasks that hold the vectors; further
blocks are further passes.

Parts and totals are exact at any size: a part beyond a long is sent as the largest long
of its sign, which only says that the pair has to be resolved from the vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

SCALE = 1024
LISTS = 2
QUERY_BLOCK = 1024
# Query blocks that are sent to all tasks in one pass: at most this many, of QUERY_BLOCK vectors each.
# They are fewer where vectors are so wide that these would be over BYTES_AT_ONCE.
BLOCKS_AT_ONCE = 16
BYTES_AT_ONCE = 64 << 20
_EXACT = 2.0**53
_LIMIT = (1 << 63) - 1


def quantised(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Integer vectors; rows without one, or with a component that is no number below 2^53 / SCALE, go.

    Rows that repeat both id and vector count once.
    """
    value = F.col(vector)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < _EXACT / SCALE)
    return (
        vectors.where(value.isNotNull() & F.forall(value, finite) & F.col(key).isNotNull())
        .select(
            F.col(key).cast("bigint").alias("id"),
            F.transform(value, lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("bigint")).alias("v"),
        )
        .distinct()
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of a matrix; shorter ones are filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=flat.dtype)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows: in doubles while these hold every sum, else in Python integers."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if bound < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, -_LIMIT, _LIMIT).astype(np.int64)


def _query_blocks(queries: DataFrame, width: int, path: str) -> None:
    """Queries, with their cutoff, packed into rows of at most QUERY_BLOCK vectors and written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, QUERY_BLOCK):
                rows = batch.slice(start, QUERY_BLOCK)
                parts = [rows.column(0).to_numpy(zero_copy_only=False), _matrix(rows.column(1), width), rows.column(2).to_numpy(zero_copy_only=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p.astype(np.int64).tobytes()], pa.binary()) for p in parts], ["ids", "matrix", "cutoff"]
                )

    blocks = queries.select("id", "v", "cutoff").mapInArrow(run, "ids binary, matrix binary, cutoff binary")
    blocks.withColumn("block", F.monotonically_increasing_id()).write.parquet(path)


_NO_CUTOFF = np.int64(-(1 << 63))


def _scan(vectors: DataFrame, path: str, width: int, lists: int, k: int, phase: int) -> DataFrame:
    """One phase over all vectors: (query, id, parts); parts that a list does not send are null.

    Phase 1 keeps the best k of each list per task, phase 2 what reaches the threshold.
    """
    bounds = [width * i // lists for i in range(lists + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            names = batch.schema.names
            column = lambda n: batch.column(names.index(n))  # noqa: E731, B023
            for row in range(batch.num_rows):
                ids = column("ids")[row].as_py()
                own = np.frombuffer(ids, dtype=np.int64)
                matrix = np.frombuffer(column("matrix")[row].as_py(), dtype=np.int64).reshape(len(own), width)
                cutoff = np.frombuffer(column("cutoff")[row].as_py(), dtype=np.int64)
                items = column("items").slice(row, 1).flatten()
                there = items.field(0).to_numpy(zero_copy_only=False)
                points = _matrix(items.field(1), width)
                parts = [_products(matrix[:, a:b], points[:, a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                apart = own[:, None] != there[None, :]
                if phase == 1:
                    for j, scores in enumerate(parts):
                        scores = np.where(apart, scores, _NO_CUTOFF)
                        top = np.argpartition(~scores, min(k, scores.shape[1]) - 1, axis=1)[:, :k]
                        value = np.take_along_axis(scores, top, axis=1)
                        for i, query in enumerate(own.tolist()):
                            found, score = there[top[i]], value[i]
                            if (query, j) in best:
                                found, score = (np.concatenate(x) for x in zip(best[query, j], (found, score), strict=True))
                                keep = np.argsort(~score, kind="stable")[:k]
                                found, score = found[keep], score[keep]
                            best[query, j] = found, score
                    continue
                reach = np.zeros(apart.shape, dtype=bool)
                # What reaches cutoff / lists, rounded up, or is beyond a long.
                least = -(-cutoff[:, None] // lists)
                sent = [apart & ((cutoff[:, None] == _NO_CUTOFF) | (scores >= least) | (scores == -_LIMIT)) for scores in parts]
                for mask in sent:
                    reach |= mask
                i, at = np.nonzero(reach)
                arrays = [pa.array(own[i]), pa.array(there[at])]
                arrays += [pa.array(s[i, at], mask=~m[i, at]) for s, m in zip(parts, sent, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["query", "id", *(f"p{j}" for j in range(lists))])
        for (query, j), (found, score) in best.items():
            good = score > _NO_CUTOFF
            arrays = [pa.array(np.full(good.sum(), query)), pa.array(found[good])]
            arrays += [pa.array(score[good]) if j == n else pa.nulls(int(good.sum()), pa.int64()) for n in range(lists)]
            yield pa.RecordBatch.from_arrays(arrays, ["query", "id", *(f"p{n}" for n in range(lists))])

    spark = vectors.sparkSession
    schema = "query bigint, id bigint, " + ", ".join(f"p{j} bigint" for j in range(lists))
    packed = vectors.mapInArrow(_pack, "items array<struct<id: bigint, v: array<bigint>>>")
    blocks = spark.read.parquet(path)
    numbers = sorted(r["block"] for r in blocks.select("block").collect())
    out = None
    step = max(1, min(BLOCKS_AT_ONCE, BYTES_AT_ONCE // (8 * QUERY_BLOCK * max(width, 1))))
    for start in range(0, max(len(numbers), 1), step):
        some = blocks.where(F.col("block").isin(numbers[start : start + step])) if numbers else blocks
        # Bounded in blocks and bytes; the stated queries meet all rows block by block.
        met = packed.withColumn("all", F.lit(0)).join(F.broadcast(some.withColumn("all", F.lit(0))), "all")
        part = met.select("ids", "matrix", "cutoff", "items").mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in lists of at most 4096, so that a query block meets many vectors at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            rows = batch.slice(start, 4096)
            struct = pa.StructArray.from_arrays([rows.column(0), rows.column(1)], ["id", "v"])
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), struct)], ["items"])


def _exact(pairs: DataFrame, vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """Totals of (query, id) pairs from the vectors, over the components both have.

    In longs while these hold every sum, else in decimals; null where no long holds the total.
    """
    shared = F.least(F.size("v"), F.size("qv"))
    both = F.slice("v", F.lit(1), shared), F.slice("qv", F.lit(1), shared)
    total = F.aggregate(F.zip_with(*both, F.try_multiply), F.lit(0).cast("bigint"), F.try_add)
    wide = F.aggregate(
        F.zip_with(*both, lambda a, b: (a.cast("decimal(17,0)") * b.cast("decimal(17,0)")).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"),
        lambda s, x: (s + x).cast("decimal(38,0)"),
    )
    near = queries.select(F.col("id").alias("query"), F.col("v").alias("qv"))
    fits = F.when(F.abs(wide) <= F.lit(_LIMIT), wide.cast("bigint"))
    return pairs.join(vectors, "id").join(near, "query").select("query", "id", F.coalesce(total, fits).alias("total"))


def _kth(totals: DataFrame, k: int) -> DataFrame:
    """The k-th best total per query, for queries that have so many."""
    totals = totals.where("total IS NOT NULL")
    order = Window.partitionBy("query").orderBy(F.desc("total"), "id")
    return totals.withColumn("n", F.row_number().over(order)).where(F.col("n") == k).select("query", F.col("total").alias("cutoff"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", lists: int = LISTS) -> DataFrame:
    """The k best other vectors of every query: query_id, rank, vec_id, score.

    Vectors are null-free and finite, with components below 2^53 / SCALE in size (8.8e12),
    or take no part; ties go to the smaller id. A query is not its own result; rows that
    repeat id and vector count once. Vectors of unequal length meet on the components both
    have. A pair whose inner product is 2^63 or more in size, which no long holds, is no
    result. Queries with fewer others return all of them; an empty table returns no row.
    """
    spark = vectors.sparkSession
    home = scratch_path(spark, "topk")
    quantised(vectors, key, vector).write.parquet(f"{home}/vectors")
    points = spark.read.parquet(f"{home}/vectors")
    queries = points.where(is_query)
    width = points.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    _query_blocks(queries.withColumn("cutoff", F.lit(int(_NO_CUTOFF))), width, f"{home}/blocks1")

    heads = _scan(points, f"{home}/blocks1", width, lists, k, 1)
    best = []
    for j in range(lists):
        order = Window.partitionBy("query").orderBy(F.desc(f"p{j}"), "id")
        one = heads.where(F.col(f"p{j}").isNotNull()).withColumn("n", F.row_number().over(order))
        best.append(one.where(F.col("n") <= k).select("query", "id"))
    pairs = best[0]
    for more in best[1:]:
        pairs = pairs.unionByName(more)
    _exact(pairs.distinct(), points, queries).write.parquet(f"{home}/first")
    first = spark.read.parquet(f"{home}/first")
    cut = _kth(first, k)
    cut_queries = queries.join(cut, queries["id"] == cut["query"], "left").select(
        "id", "v", F.coalesce("cutoff", F.lit(int(_NO_CUTOFF))).alias("cutoff")
    )
    _query_blocks(cut_queries, width, f"{home}/blocks2")

    _scan(points, f"{home}/blocks2", width, lists, k, 2).write.parquet(f"{home}/second")
    second = spark.read.parquet(f"{home}/second")
    parts = [F.col(f"p{j}") for j in range(lists)]
    whole, known, beyond = parts[0].isNotNull(), F.coalesce(parts[0], F.lit(0)), F.abs(F.coalesce(parts[0], F.lit(0))) == _LIMIT
    missing = parts[0].isNull().cast("int")
    for p in parts[1:]:
        sent = F.coalesce(p, F.lit(0))
        whole, known, beyond, missing = whole & p.isNotNull(), F.try_add(known, sent), beyond | (F.abs(sent) == _LIMIT), missing + p.isNull().cast("int")
    # Sums that pass the limits of a long on the way are resolved from the vectors too.
    beyond = beyond | known.isNull()
    complete = second.where(whole & ~beyond).select("query", "id", known.alias("total"))
    better = _kth(first.unionByName(complete).distinct(), k).withColumnRenamed("cutoff", "better")
    exactly = lambda x: F.col(x).cast("decimal(20,0)")
    rest = (
        second.where(~whole | beyond).withColumn("known", known).withColumn("missing", missing).withColumn("beyond", beyond)
        .join(cut, "query", "left").join(better, "query", "left")
        # A missing part is below cutoff / lists.
        .where(F.col("beyond") | F.col("better").isNull() | F.col("cutoff").isNull()
               | (exactly("known") * lists + exactly("cutoff") * F.col("missing") >= exactly("better") * lists))
        .select("query", "id").join(first, ["query", "id"], "left_anti")
    )
    totals = first.unionByName(complete).unionByName(_exact(rest, points, queries)).where("total IS NOT NULL").distinct()
    order = Window.partitionBy("query").orderBy(F.desc("total"), "id")
    return (
        totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), F.col("total").alias("score"))
    )
