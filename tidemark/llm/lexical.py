"""Ranked lexical search by NRA: impact-sorted lists read in turn, with score intervals.

Documents are dealt over tasks. A task keeps the postings of a stretch of its documents
(a segment of bounded size) as one list per term, highest impact first. For every item it
reads the lists of the item's terms side by side, deeper each round. Every document met has
a lower bound, what was read of it, and an upper bound, which adds the current head of each
list it has not been met in. Once no unmet document can reach the best scores, only the
documents whose upper bound still does are followed; they are read on until every interval
is closed. So a segment gives exact scores and exact ties; the segments' best are merged.

Segments, rather than one list per term over all documents: the twentieth score of an item
is low against the sum of its lists' heads, so lists must be read to some three quarters
before unmet documents are ruled out (measured: README). As rows of a table these reads
would be shuffled; in a segment they stay arrays of the task. The best scores of earlier
segments of a task raise the bar for later ones.

Items are taken in blocks of bounded size. Only a block's terms and weights are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.joins import stored
from tidemark.llm.ragged import flat_index, pieces, slice_hashes
from tidemark.llm.words import lower_ascii

# Parameters of the term weights.
SCALE, TOP, SATURATION, FLAT, SLOPE = 1000, 1_000_000_000, 12, 75, 25
# Term occurrences of the items of a block, postings of a segment, first depth of reads.
BLOCK_TERMS = 1 << 19
SEGMENT = 1 << 21
DEPTH = 64
# Groups of tasks whose best meet before all meet.
MERGE_GROUPS = 64

_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def term_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of every term, and the text it is in.

    A term is a run of ASCII letters and digits and of all characters beyond ASCII, whose
    bytes all lie beyond 0x7F.
    """
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = _TERM[data]
    opens, ends = inside[:-1].copy(), inside[:-1].copy()
    opens[1:] &= ~inside[:-2]
    ends &= ~inside[1:]
    # A text begins and ends terms, whatever its neighbours hold.
    filled = np.flatnonzero(np.diff(offsets) > 0)
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    opens[first] = inside[first]
    ends[last] = inside[last]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(ends) + 1 - starts, np.searchsorted(offsets, starts, side="right") - 1


def terms_of(text: str | None) -> list[bytes]:
    data = lower_ascii(np.frombuffer((text or "").encode(), dtype=np.uint8))
    starts, lengths, _ = term_places(data, np.array([0, len(data)]))
    raw = data.tobytes()
    return [raw[a : a + n] for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]


class Vocabulary:
    """Terms of a block of items; finds them among slices of bytes, exactly."""

    def __init__(self, terms: Sequence[bytes]) -> None:
        self.lengths = np.array([len(t) for t in terms], dtype=np.int64)
        self.data = np.frombuffer(b"".join(terms), dtype=np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths
        hashes = slice_hashes(self.data, self.starts, self.lengths) if terms else np.zeros(0, dtype=np.uint64)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        if len(np.unique(self.hashes)) < len(terms):
            raise ValueError("two terms of a block have one hash")

    def __len__(self) -> int:
        return len(self.lengths)

    def find(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Number of the term of each slice, -1 for slices that are no term of the block."""
        out = np.full(len(starts), -1, dtype=np.int64)
        if not len(starts) or not len(self):
            return out
        hashes = slice_hashes(data, starts, lengths)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        met = np.flatnonzero(self.hashes[at] == hashes)
        term = self.order[at[met]]
        same = self.lengths[term] == lengths[met]
        met, term = met[same], term[same]
        size = lengths[met]
        odd = data[flat_index(starts[met], size)] != self.data[flat_index(self.starts[term], size)]
        good = np.ones(len(met), dtype=bool)
        good[np.repeat(np.arange(len(met)), size)[odd]] = False
        out[met[good]] = term[good]
        return out


@dataclass(frozen=True)
class Block:
    """Items with their distinct terms and how often each holds them."""

    items: tuple[int, ...]
    terms: tuple[tuple[np.ndarray, np.ndarray], ...]
    vocabulary: Vocabulary


def _postings(docs: DataFrame, block: Block, text: str, key: str) -> DataFrame:
    """Per row: its key, number of terms, and the block's terms in it with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(block.vocabulary)

    def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for rows, data, offsets in pieces(batch):
                data = lower_ascii(data)
                starts, lengths, owner = term_places(data, offsets)
                n = np.bincount(owner, minlength=rows.num_rows)
                term = known.find(data, starts, lengths)
                pair, tf = np.unique((owner * max(len(known), 1) + term)[term >= 0], return_counts=True)
                doc = pair // max(len(known), 1)
                bounds = np.searchsorted(doc, np.arange(rows.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(n.astype(np.int64)), lists(pair % max(len(known), 1), bounds), lists(tf, bounds)], ["key", "n", "terms", "tfs"]
                )

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "key bigint, n bigint, terms array<int>, tfs array<int>")


class Segment:
    """Postings of a stretch of documents, one list per term, highest impact first."""

    def __init__(self, keys: np.ndarray, missing: np.ndarray, docs: np.ndarray, terms: np.ndarray, impacts: np.ndarray, count: int) -> None:
        order = np.lexsort((-impacts, terms))
        self.keys, self.missing = keys, missing
        self.docs, self.impacts = docs[order], impacts[order]
        self.bounds = np.searchsorted(terms[order], np.arange(count + 1))

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the k best of all, with exact scores of at least ``bar``.

        ``bar`` is a score that k documents elsewhere reach, or 0. Among equal scores the
        smaller keys come first, missing ones last.
        """
        start, stop = self.bounds[terms], self.bounds[terms + 1]
        some = (stop > start) & (weights > 0)
        start, stop, weights = start[some], stop[some], weights[some]
        if not len(start):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        low = np.zeros(len(self.keys), dtype=np.int64)
        at, depth, bar, followed = start.copy(), DEPTH, max(bar, 1), None
        while True:
            upto = np.minimum(start + depth, stop)
            for j in np.flatnonzero(upto > at):
                docs, read = self.docs[at[j] : upto[j]], weights[j] * self.impacts[at[j] : upto[j]]
                if followed is not None:
                    mine = followed[docs]
                    docs, read = docs[mine], read[mine]
                low[docs] += read
            at = upto
            left = at < stop
            heads = np.where(left, weights * self.impacts[np.minimum(at, len(self.impacts) - 1)], 0)
            reach = int(heads.sum())
            met = np.flatnonzero(low)
            if len(met) >= k:
                bar = max(bar, int(np.partition(low[met], len(met) - k)[len(met) - k]))
            if not reach:
                break
            if reach < bar or followed is not None:
                # What the lists still hold for a document: their heads, but for lists it was met in.
                gap = np.full(len(low), reach, dtype=np.int64)
                for j in np.flatnonzero(left):
                    gap[self.docs[start[j] : at[j]]] -= heads[j]
                alive = (low > 0) & (low + gap >= bar)
                if followed is not None:
                    alive &= followed
                followed = alive
                low[~followed] = 0
                if not gap[followed].any():
                    break
            depth *= 2
        met = np.flatnonzero(low >= bar)
        order = np.lexsort((self.keys[met], self.missing[met], -low[met]))[:k]
        return met[order], low[met[order]]


def _segment_best(postings: DataFrame, block: Block, weights: np.ndarray, docs: int, length: int, k: int, size: int) -> DataFrame:
    """(place, doc_id, score): of every segment the best documents of every item of the block."""
    spark = postings.sparkSession
    shared = spark.sparkContext.broadcast((block.terms, weights))
    # Exact in integers of any size; a row's value is small.
    m = F.lit(100 - SLOPE) + F.expr(f"({SLOPE} * cast(n AS decimal(38,0)) * {docs}) div {max(length, 1)}")
    rows = postings.where("size(terms) > 0").select("key", m.alias("m"), "terms", "tfs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = shared.value
        bars = [np.zeros(0, dtype=np.int64) for _ in items]

        def search(parts: list) -> Iterator[pa.RecordBatch]:
            keys, missing, m, sizes, terms, tfs = (np.concatenate(c) for c in zip(*parts, strict=True))
            owner = np.repeat(np.arange(len(keys)), sizes)
            segment = Segment(keys, missing, owner, terms, TOP * tfs // (SCALE * tfs + SATURATION * m[owner]), len(weight))
            out = []
            for place, (mine, times) in enumerate(items):
                seen = bars[place]
                found, scores = segment.best(mine, weight[mine] * times, k, int(seen[0]) if len(seen) >= k else 0)
                bars[place] = np.sort(np.concatenate([seen, scores]))[-k:]
                out.append((np.full(len(found), place), keys[found], missing[found], scores))
            place, key, gone, score = (np.concatenate(c) for c in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(place.astype(np.int32)), pa.array(key, mask=gone), pa.array(score)], ["place", "doc_id", "score"]
            )

        parts, held = [], 0
        for batch in batches:
            column = batch.column(0)
            sizes = np.diff(batch.column(2).offsets.to_numpy()).astype(np.int64)
            flat = [batch.column(i).flatten().to_numpy().astype(np.int64) for i in (2, 3)]
            parts.append((column.fill_null(0).to_numpy(), column.is_null().to_numpy(zero_copy_only=False), batch.column(1).to_numpy(), sizes, *flat))
            held += len(flat[0])
            if held >= size:
                yield from search(parts)
                parts, held = [], 0
        if parts:
            yield from search(parts)

    return rows.mapInArrow(run, "place int, doc_id bigint, score bigint")


def _blocks(spark, items: DataFrame, item: str, text: str) -> Iterator[tuple[Block, list]]:
    """Items in blocks of at most BLOCK_TERMS term occurrences, or one item; read one by one."""
    held, size = [], 0
    for row in items.select(F.col(item).alias("item"), F.col(text).alias("text")).toLocalIterator():
        terms = terms_of(row["text"])
        if held and size + len(terms) > BLOCK_TERMS:
            yield _block(held)
            held, size = [], 0
        held.append((row["item"], terms))
        size += len(terms)
    if held:
        yield _block(held)


def _block(held: list) -> tuple[Block, list]:
    number: dict[bytes, int] = {}
    lists = []
    for _, terms in held:
        ids, times = np.unique(np.array([number.setdefault(t, len(number)) for t in terms], dtype=np.int64), return_counts=True)
        lists.append((ids, times.astype(np.int64)))
    return Block(tuple(range(len(held))), tuple(lists), Vocabulary(list(number))), [h[0] for h in held]


def search(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents with a score above 0 per item.

    Every row of ``docs`` is a document, every row of ``items`` an item: repeated rows are
    ranked each for itself, and items that share an id share it in the result too. Equal
    scores go by ascending document id, null ids last. Null and empty texts have no terms:
    such documents are in no list and not counted, such items find nothing. Whole texts are
    read. Without items or documents there is no result. Only the named columns are read.
    ``segment`` bounds the postings that a task holds at once, but for the last batch.
    """
    spark = docs.sparkSession
    kind = items.schema[item].dataType
    out = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id bigint, score bigint")
    for block, ids in _blocks(spark, items, item, item_text):
        postings = stored(_postings(docs, block, text, key), "postings")
        total = postings.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(block.vocabulary), dtype=np.int64)
        # One row per term of the block.
        for term, count in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[term] = count
        weights = np.floor(SCALE * np.log((2 * total[0] + 2) / (2 * df + 1))).astype(np.int64)
        best = _segment_best(postings, block, weights, total[0], total[1], k, segment)
        best = best.withColumn("group", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        for by in (["place", "group"], ["place"]):
            best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(ids)), f"place int, item_id {kind.simpleString()}")
        # At most one row per item of the block.
        out = out.unionByName(best.join(F.broadcast(names), "place").select("item_id", "rank", "doc_id", "score"))
    return out
