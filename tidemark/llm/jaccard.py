"""Exact Jaccard join of word-shingle sets, size-aware: subsets for small sets, lists for large.

Two sets of sizes m and n reach a similarity of 3/4 when they share c = ceil(3 (m + n) / 7)
shingles. A small set enumerates all its subsets of the sizes c it may need, and sets that
name one subset are linked without any further check. A large set names the shingles of its
prefix: the first n - ceil(3 n / 4) + 1 of an order common to all sets, of which two similar
sets share one. Sets near the boundary do both. The boundary is the size up to which
enumerating costs less than scanning, from the counts of all set sizes.

The order puts frequent shingles last. Frequencies come from a sketch of fixed size that
all documents fill: it only decides which lists are scanned, never what is linked.

Entries carry their position in the order: sets of sizes m and n that are similar share a
shingle that is among the first m - c + 1 of one and the first n - c + 1 of the other, so
members of a list that stand later do not meet there.

Lists are scanned in two rounds. First every member of a list meets the list's pivot, the
member with the earliest position, which has the fewest shingles of its own; candidates
are checked on the texts. Members that are then in one component need not
meet any more; members of one list in different components all meet in the second round.
So no link between components is lost, and groups of thousands of near copies need a
number of checks in proportion to their size. Documents with equal sets are one node.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.joins import components, narrow_join, stored
from tidemark.llm.ragged import LEAN, mix, pieces, slice_hashes, text_bytes
from tidemark.llm.words import lower_ascii, window_hashes, window_places, word_places

SHINGLE = 5
SKETCH_BITS = 22
SKETCH_BLOCKS = 256
LARGEST_SMALL = 12
# Cost of one entry of a scanned list, with the checks it causes, in enumerated subsets.
SCAN_COST = 8
PIVOTS = 4
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


def needed(m: int, n: int) -> int:
    """Shingles that sets of these sizes share at a similarity of 3/4 or more."""
    return -(-3 * (m + n) // 7)


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - (3 * n + 3) // 4 + 1


def subset_sizes(n: int, boundary: int) -> list[int]:
    """Sizes of the subsets that a set of n shingles enumerates to meet all small sets."""
    partners = range(-(-3 * n // 4), min(boundary, 4 * n // 3) + 1)
    return sorted({needed(n, m) for m in partners})


def choose_boundary(sizes: dict[int, int]) -> int:
    """The largest size of small sets, by the cost of both ways over these counts of sizes."""
    def cost(boundary: int) -> int:
        total = 0
        for n, count in sizes.items():
            if n <= boundary:
                total += count * sum(comb(n, c) for c in subset_sizes(n, boundary))
            if 4 * n >= 3 * (boundary + 1):
                total += count * int(prefix_length(np.array(n))) * SCAN_COST
        return total

    return min(range(LARGEST_SMALL + 1), key=lambda b: (cost(b), b))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted 64-bit hashes of every text's distinct shingles."""
    data = lower_ascii(data)
    starts, lengths, owner = word_places(data, offsets)
    texts = len(offsets) - 1
    counts = np.bincount(owner, minlength=texts)
    hashes = slice_hashes(data, starts, lengths)
    first = window_places(counts, SHINGLE)
    windows = window_hashes(hashes, first, SHINGLE)
    of = np.concatenate([[0], np.cumsum(np.maximum(counts - SHINGLE + 1, 0))])
    word = np.concatenate([[0], np.cumsum(counts)])
    out = []
    for i, count in enumerate(counts.tolist()):
        if count >= SHINGLE:
            out.append(_sorted_unique(windows[of[i] : of[i + 1]]))
        elif count:
            out.append(slice_hashes(hashes, word[i : i + 1], np.array([count])))
        else:
            out.append(hashes[:0])
    return out


def _sorted_unique(values: np.ndarray) -> np.ndarray:
    ordered = np.sort(values)
    return ordered[np.r_[True, ordered[1:] != ordered[:-1]]]


def _set_keys(one: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    a, b = np.add.reduce(mix(one)), np.add.reduce(mix(one ^ _PAIR))
    return int(np.uint64(a).astype(np.int64)), int(np.uint64(b).astype(np.int64))


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _scan_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and key of every set; at the end the task's counts of all sketch cells."""
    names = ["doc_id", "n", "k1", "k2", "block", "cells"]
    counts, seen = np.zeros(1 << SKETCH_BITS, dtype=np.int32), set()
    for batch in batches:
        for rows, data, offsets in pieces(batch, size=LEAN):
            sets = shingle_sets(data, offsets)
            keys = [_set_keys(s) for s in sets]
            new = []
            for s, key in zip(sets, keys, strict=True):
                if key not in seen:
                    seen.add(key)
                    new.append(s)
            if new:
                np.add(counts, np.bincount(_cells(np.concatenate(new)), minlength=len(counts)).astype(np.int32), out=counts)
            size = rows.num_rows
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([len(s) for s in sets], pa.int32()), pa.array([k[0] for k in keys], pa.int64()),
                 pa.array([k[1] for k in keys], pa.int64()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary())],
                names,
            )
    parts = [zlib.compress(p.tobytes(), 1) for p in np.split(counts, SKETCH_BLOCKS)]
    empty = [pa.nulls(SKETCH_BLOCKS, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())]
    yield pa.RecordBatch.from_arrays([*empty, pa.array(range(SKETCH_BLOCKS), pa.int32()), pa.array(parts, pa.binary())], names)


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Levels of the summed cells, by quarter powers of two; memory is that of the sketch."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts = np.frombuffer(zlib.decompress(packed), dtype=np.int32).astype(np.int64)
            sums[block] = sums[block] + counts if block in sums else counts
    for block, counts in sums.items():
        levels = np.minimum(4 * np.log2(1.0 + counts), 255).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([levels.tobytes()], pa.binary())], ["block", "levels"])


def _subset_keys(one: np.ndarray, boundary: int) -> list[tuple[int, int]]:
    """(key, subset size) of all subsets that a small set names."""
    hashed = mix(one)
    out = []
    for size in subset_sizes(len(one), boundary):
        for chosen in combinations(range(len(one)), size):
            key = mix(np.add.reduce(hashed[list(chosen)], keepdims=True) ^ mix(np.array([size])))[0]
            out.append((int(key.astype(np.int64)), size))
    return out


def _entries(docs: DataFrame, levels: bytes, boundary: int) -> DataFrame:
    """(key, doc, c, n) of every list entry.

    ``c`` holds the subset size, 0 for prefixes, above the position; ``n`` is the set size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(shared.value, dtype=np.uint8)
        seen = set()
        for batch in batches:
            for rows, data, offsets in pieces(batch, size=LEAN):
                keys, owners, kinds = [], [], []
                for document, one in zip(rows.column(0).to_pylist(), shingle_sets(data, offsets), strict=True):
                    n = len(one)
                    if not n or document is None:
                        continue
                    mark = _set_keys(one)
                    if mark in seen:
                        continue
                    seen.add(mark)
                    if n <= boundary:
                        for key, size in _subset_keys(one, boundary):
                            keys.append(np.array([key]))
                            owners.append((document, n, 1))
                            kinds.append(np.array([size << 32]))
                    if 4 * n >= 3 * (boundary + 1):
                        size = int(prefix_length(np.array(n)))
                        # Rank: level of the cell, then the hash; equal for all sets.
                        rank = level[_cells(one)].astype(np.uint64) << np.uint64(56) | mix(one) >> np.uint64(8)
                        first = np.argpartition(rank, size - 1)[:size]
                        keys.append(one[first[np.argsort(rank[first])]].astype(np.int64))
                        owners.append((document, n, size))
                        kinds.append(np.arange(size))
                if not keys:
                    continue
                ids, sizes, counts = (np.array(x) for x in zip(*owners, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.repeat(ids, counts)), pa.array(np.concatenate(kinds)), pa.array(np.repeat(sizes, counts).astype(np.int32))],
                    ["key", "doc", "c", "n"],
                )

    return docs.mapInArrow(run, "key bigint, doc bigint, c bigint, n int")


_RUN = ("key", "doc", "c", "n", "pivot", "pivot_c", "pivot_n")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of lists with two members or more, with the list's first member as pivot.

    Rows come sorted by list; a list may be of any length, only its pivot is held.
    """
    held, sent = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy() for i in range(4)]
        if held is not None:
            columns = [np.r_[one, column] for one, column in zip(held, columns, strict=True)]
        key, _, c, _ = columns
        begins = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (c[1:] >> 32 != c[:-1] >> 32)])
        counts = np.diff(np.r_[begins, len(key)])
        pivot = np.repeat(begins, counts)
        many = np.repeat(counts > 1, counts)
        last = begins[-1]
        if held is not None and sent:
            many[0] = False
        sent = bool(counts[-1] > 1 or (last == 0 and sent))
        held = [column[last : last + 1] for column in columns]
        at = np.flatnonzero(many)
        arrays = [column[at] for column in columns] + [column[pivot[at]] for column in columns[1:]]
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], list(_RUN))


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) whose texts have similar sets."""
    for batch in batches:
        sizes = np.cumsum(pc.add(pc.binary_length(batch.column(2).fill_null("")), pc.binary_length(batch.column(3).fill_null(""))).to_numpy())
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + (1 << 20), side="right")))
            rows = batch.slice(start, stop - start)
            start, half = stop, rows.num_rows
            sets = shingle_sets(*text_bytes(pa.concat_arrays([rows.column(2), rows.column(3)])))
            good = np.zeros(half, dtype=bool)
            for i, (a, b) in enumerate(zip(sets[:half], sets[half:], strict=True)):
                if 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)) > 0:
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    good[i] = 4 * common >= 3 * (len(a) + len(b) - common)
            keep = pa.array(good)
            yield pa.RecordBatch.from_arrays([rows.column(0).filter(keep), rows.column(1).filter(keep)], ["a", "b"])


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Of stored candidate pairs, those that are links; reads the texts of their members."""
    most, joined = pairs.count(), pairs
    for side in ("a", "b"):
        texts = docs.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}"))
        joined = joined.join(narrow_join(texts, pairs.select(side).distinct(), side, "left_semi", most), side)
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(_check, "a bigint, b bigint").distinct()


def _may_link(n: str, c: str, n2: str, c2: str) -> Column:
    """Whether sets of these sizes may be similar and share, at these places, their first shingle."""
    a, b = F.col(n).cast("bigint"), F.col(n2).cast("bigint")
    common = F.floor((3 * (a + b) + 6) / 7).cast("bigint")
    return (4 * F.least(a, b) >= 3 * F.greatest(a, b)) & (F.col(c) <= a - common) & (F.col(c2) <= b - common)


def _ordered(frame: DataFrame, x: str, y: str) -> DataFrame:
    return frame.where(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def join_components(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Sets are the distinct five-word shingles of the lower-cased text, of fewer words the
    whole sequence as one; a text without words, or null, has an empty set and links with
    nothing. Ids are integers. Rows that share an id are one node, linked by any of their
    texts; a row without an id links with nothing and has no component. An empty table
    gives no row.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    scanned = stored(docs.mapInArrow(_scan_sets, "doc_id bigint, n int, k1 bigint, k2 bigint, block int, cells binary"), "sets")
    sets = scanned.where(F.col("block").isNull()).select("doc_id", "n", "k1", "k2")
    blocks = scanned.where(F.col("block").isNotNull()).select("block", "cells").repartition("block").mapInArrow(_sum_blocks, "block int, levels binary")
    # The sketch has a fixed size: one byte for each of 2^SKETCH_BITS cells.
    got = {r["block"]: bytes(r["levels"]) for r in blocks.collect()}
    levels = b"".join(got.get(b, bytes((1 << SKETCH_BITS) // SKETCH_BLOCKS)) for b in range(SKETCH_BLOCKS))
    sizes = {r["n"]: r["count"] for r in sets.where((F.col("n") > 0) & (F.col("n") <= 2 * LARGEST_SMALL)).groupBy("n").count().collect()}
    boundary = choose_boundary(sizes)

    # Stored, so that a set that very many documents have can be split in the join.
    first = stored(sets.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "classes")
    members = sets.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).join(first, ["k1", "k2"]).select(F.col("doc_id").alias("doc"), "rep").distinct()
    # A document of one class is that class. One whose rows have several is a node of its own,
    # linked to each: no other id has all its texts, and pairs are checked on a node's texts.
    members = stored(members, "members")
    one = F.min("rep") == F.max("rep")
    node = stored(members.groupBy("doc").agg(F.when(one, F.min("rep")).otherwise(F.col("doc")).alias("rep")), "nodes")

    kind, place = F.shiftright("c", 32), F.col("c").bitwiseAND((1 << 32) - 1)
    order = [F.when(kind > 0, F.col("n")).otherwise(place), F.xxhash64("doc", F.pmod("key", F.lit(PIVOTS)))]
    listed = _entries(docs, levels, boundary).repartition("key").sortWithinPartitions("key", kind, *order)
    schema = ", ".join(f"{c} {'int' if c.endswith('n') else 'bigint'}" for c in _RUN[:-1]) + ", pivot_n int"
    lists = stored(listed.mapInArrow(_runs, schema), "lists")

    sure = lists.where((kind > 0) & (3 * (F.col("n") + F.col("pivot_n")) <= 7 * kind))
    scanned = lists.where(kind == 0)
    met = _ordered(scanned.where(_may_link("n", "c", "pivot_n", "pivot_c")), "doc", "pivot")
    pairs = stored(_ordered(_to_nodes(met, node), "a", "b"), "pairs")
    known = _ordered(_to_nodes(_ordered(sure, "doc", "pivot"), node), "a", "b")
    known = known.unionByName(_ordered(members.join(node.withColumnRenamed("rep", "own"), "doc"), "rep", "own"))
    edges = stored(known.unionByName(_verified(pairs, docs)), "links")
    label = stored(components(edges), "components")

    # Second round: lists whose members are in several components.
    entries = narrow_join(scanned.select("key", "doc", "c", "n"), node, "doc").select("key", F.col("rep").alias("node"), "c", "n")
    entries = narrow_join(entries, label, "node", "left").select("key", "node", "c", "n", F.coalesce("component", "node").alias("component")).distinct()
    entries = stored(entries, "entries")
    mixed = entries.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    open_ = stored(entries.join(mixed, "key", "left_semi"), "open")
    other = open_.select("key", F.col("node").alias("node2"), F.col("c").alias("c2"), F.col("n").alias("n2"), F.col("component").alias("component2"))
    across = open_.join(other, "key").where((F.col("component") < F.col("component2")) & _may_link("n", "c", "n2", "c2"))
    left = stored(_ordered(across, "node", "node2").join(pairs, ["a", "b"], "left_anti"), "left")
    if left.limit(1).count():
        more = stored(_verified(left, docs), "more")
        if more.limit(1).count():
            label = stored(components(edges.unionByName(more)), "components")

    by_doc = narrow_join(node, label.withColumnRenamed("node", "rep"), "rep", "left").select(F.col("doc").alias("doc_id"), F.coalesce("component", "rep").alias("component"))
    found = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return narrow_join(sets, by_doc, "doc_id", "left", node.count()).select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), found.alias("component_id"))


def _to_nodes(pairs: DataFrame, node: DataFrame) -> DataFrame:
    """Pairs of documents as pairs of the nodes that stand for their sets."""
    a = narrow_join(pairs, node.select(F.col("doc").alias("a"), F.col("rep").alias("ra")), "a")
    return narrow_join(a, node.select(F.col("doc").alias("b"), F.col("rep").alias("rb")), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
