"""Quality of documents by supervised embeddings of words and parts of words.

Words, pairs of neighbouring words and runs of characters are hashed to vectors that are
learned together with a softmax layer, by stochastic gradient descent on the driver, from
a bounded sample of labelled documents (SAMPLE). A document's vector is the mean of three
means: of its words, of its pairs and of its runs of characters. Every text is scored
whole. A pair is hashed by the difference of its words' hashes: all pairs of a word with
itself share one vector, so repetition is learned without seeing the word.

For scoring, the output layer is applied to the vectors beforehand. As a document's vector
is a sum, this leaves one number per vector to add up, and the score is the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ragged import mix, pieces, slice_hashes
from tidemark.llm.tokenize import key_type
from tidemark.llm.words import word_places

# Labelled documents of each label that are used at most.
SAMPLE = 1500
HOLD_OUT, HELD = 4, 2
KEPT_FROM = 0.7
# Hashed vectors and their width; lengths of runs of characters.
BITS, WIDTH = 16, 16
RUNS = (2, 4)
EPOCHS, RATE, DECAY, SEED = 8, 0.6, 1e-4, 11
KINDS = 3


@dataclass(frozen=True)
class Model:
    """What every hashed vector adds to the log-odds of label 1, and the log-odds without any."""

    parts: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        line = np.full(len(offsets) - 1, self.bias)
        for bucket, owner in features(data, offsets):
            count = np.bincount(owner, minlength=len(line))
            line += np.bincount(owner, self.parts[bucket], len(line)) / (KINDS * np.maximum(count, 1))
        return 1 / (1 + np.exp(-np.clip(line, -60, 60)))


def held_out(key: str = "doc_id") -> Column:
    """Whether a document's label is kept from learning: by the CRC-32 of its id as text; not without id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % HOLD_OUT == HELD, F.lit(False))


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and text of every word, then of every pair of words, then of every run of characters."""
    keep = np.uint64(64 - BITS)
    starts, lengths, owner = word_places(data, offsets)
    words = slice_hashes(data, starts, lengths) if len(starts) else np.zeros(0, dtype=np.uint64)
    yield (mix(words + np.uint64(1)) >> keep).astype(np.int64), owner
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    yield (mix(words[pair + 1] - words[pair] + np.uint64(2)) >> keep).astype(np.int64), owner[pair]
    # Runs of characters, blanks included, as slices that begin and end between characters.
    first = np.flatnonzero((data & 0xC0) != 0x80)
    text = np.searchsorted(offsets, first, side="right") - 1
    edges = np.append(first, len(data))
    buckets, owners = [], []
    for size in RUNS:
        at = np.arange(max(len(first) - size + 1, 0))
        at = at[text[at] == text[at + size - 1]]
        runs = slice_hashes(data, edges[at], edges[at + size] - edges[at]) if len(at) else np.zeros(0, dtype=np.uint64)
        buckets.append((mix(runs + np.uint64(3)) >> keep).astype(np.int64))
        owners.append(text[at])
    yield np.concatenate(buckets), np.concatenate(owners)


def _weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per labelled text its distinct buckets, and the share of each in the mean of the text."""
    for batch in batches:
        for rows, data, offsets in pieces(batch):
            count, pairs, shares = rows.num_rows, [], []
            for bucket, owner in features(data, offsets):
                pairs.append((owner << BITS) + bucket)
                shares.append(1 / (KINDS * np.maximum(np.bincount(owner, minlength=count), 1))[owner])
            pair, place = np.unique(np.concatenate(pairs), return_inverse=True)
            share = np.bincount(place, np.concatenate(shares), len(pair)).astype("<f4")
            bounds = np.searchsorted(pair >> BITS, np.arange(count + 1)).tolist()
            bucket = (pair & ((1 << BITS) - 1)).astype("<i4")
            blobs = [[a[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)] for a in (bucket, share)]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *(pa.array(b, pa.binary()) for b in blobs)], ["doc", "label", "buckets", "shares"])


def train(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, output layer and its bias, from (buckets, shares) and label of every text.

    One text at a time, in an order drawn anew for each pass, with a falling rate. The
    buckets of a text are distinct, so its step is a plain assignment.
    """
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BITS, WIDTH)).astype(np.float32)
    layer, bias = rng.uniform(-1, 1, (2, WIDTH)).astype(np.float32), np.zeros(2, dtype=np.float32)
    steps, done = EPOCHS * len(texts), 0
    weight = len(labels) / (2 * np.bincount(labels, minlength=2).astype(np.float64))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(texts)).tolist():
            rate = RATE * (1 - done / steps)
            done += 1
            bucket, share = texts[i]
            hidden = share @ vectors[bucket]
            line = layer @ hidden + bias
            p = np.exp(line - line.max())
            p /= p.sum()
            p[labels[i]] -= 1
            p *= rate * weight[labels[i]]
            back = p @ layer
            layer -= np.outer(p, hidden) + rate * DECAY * layer
            bias -= p
            # Steps of a bucket are divided by the largest share of the text, not by its length.
            vectors[bucket] -= np.outer(share / max(float(share.max(initial=0)), 1e-9), back)
    return vectors, layer, bias


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text") -> Model | None:
    """A model from labels that are not held out; none if these lack a label.

    Rows without id, text or label teach nothing. Of several labels of one id the largest
    counts. SAMPLE documents per label, chosen by a hash of the id, are used; the share of
    the labels among all that may teach sets the bias.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    known = known.groupBy(F.col(key).cast("bigint").alias("doc")).agg((F.max(label) > 0).cast("int").alias("label"))
    total = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(total) < 2:
        return None
    parts = [known.where(F.col("label") == v).orderBy(F.xxhash64("doc"), "doc").limit(SAMPLE) for v in (0, 1)]
    # At most 2 * SAMPLE rows; of rows that share an id the first text by its bytes.
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text")).join(chosen, "doc")
    rows = rows.groupBy("doc", "label").agg(F.min("text").alias("text"))
    seen = rows.mapInArrow(_weighted, "doc bigint, label int, buckets binary, shares binary").toArrow().sort_by("doc")
    truth = seen.column("label").to_numpy()
    if len(np.unique(truth)) < 2:
        return None
    texts = [(np.frombuffer(b.as_py(), dtype="<i4"), np.frombuffer(s.as_py(), dtype="<f4")) for b, s in zip(seen.column("buckets"), seen.column("shares"), strict=True)]
    vectors, layer, bias = train(texts, truth)
    prior = float(np.log(total[1] / total[0]))
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]) + prior)


def score(docs: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Null and empty texts have no feature and get the score of that. Without a model every
    score is 1: nothing is known against a document. Repeated rows get equal scores; an
    empty table gives no row. No other column is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part, data, offsets in pieces(batch):
                scores = known.scores(data, offsets) if known else np.ones(part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(scores), pa.array((scores >= KEPT_FROM).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(key).alias("doc_id"), held_out(key).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {key_type(docs, key)}, held_out boolean, score double, predicted int")
