"""Toxicity of documents: a recurrent network over all overlapping windows of every text.

The network (`gru`) is fitted by one task, on windows of a bounded sample of labelled
documents; SAMPLE and WINDOWS bound it, and the driver gets the fitted network only. A second part of that sample, scored whole, fits
how the scores of all windows of a document make its score: by the best window, the
share of windows over the line, and their number. Every text is scored whole.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import gru
from tidemark.llm.ragged import pieces
from tidemark.llm.tokenize import key_type

# Labelled documents of each label that are used at most, and windows of each.
SAMPLE = 1500
WINDOWS = 12
HOLD_OUT = 5


@dataclass(frozen=True)
class Model:
    """The network, and how window logits make the score of a document."""

    network: dict
    coefficients: tuple[float, ...]

    def scores(self, features: np.ndarray) -> np.ndarray:
        line = self.coefficients[0] + features @ np.array(self.coefficients[1:])
        return 1 / (1 + np.exp(-np.clip(line, -60, 60)))


def held_out(key: str = "doc_id"):
    """Whether a document's label is kept from learning: by the CRC-32 of its id as text."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % HOLD_OUT == 0, F.lit(False))


def features(network: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text: best logit, share of windows over 0, logarithm of the number of windows; 0 without words."""
    texts = len(offsets) - 1
    out = np.zeros((texts, 3))
    words = gru.Words(data, offsets)
    if not len(words.owner):
        return out
    logits, text = gru.score_windows(network, words)
    heads = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    count = np.diff(np.r_[heads, len(text)])
    out[text[heads], 0] = np.maximum.reduceat(logits, heads)
    out[text[heads], 1] = np.add.reduceat((logits > 0).astype(np.float64), heads) / count
    out[text[heads], 2] = np.log1p(count)
    return out


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At most WINDOWS windows of each labelled text, spread over all of it."""
    for batch in batches:
        out = []
        for doc, label, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            words = text.encode().split()
            starts = list(range(0, max(len(words) - gru.WINDOW, 0) + 1, gru.STRIDE))
            for i in sorted({round(k * (len(starts) - 1) / max(WINDOWS - 1, 1)) for k in range(WINDOWS)}):
                some = b" ".join(w[:64] for w in words[starts[i] : starts[i] + gru.WINDOW]).decode(errors="ignore")
                if some:
                    out.append((doc, label, some))
        columns = list(zip(*out, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.string()), strict=True)], ["doc", "label", "text"])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The network of all windows (doc, label, text), in whatever order they come; none if they lack a label."""
    seen = sorted(row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in (0, 2, 1)), strict=True))
    labels = np.array([s[2] for s in seen])
    if len(set(labels.tolist())) == 2:
        mixed = np.random.default_rng(5).permutation(len(seen))
        network = gru.train([seen[i][1] for i in mixed], labels[mixed], np.array([s[0] for s in seen])[mixed])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(network)], pa.binary())], ["network"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text") -> Model | None:
    """A model from labels that are not held out; none if these lack a label.

    Rows without id, text or label teach nothing. Of several labels of one id the largest
    counts. SAMPLE documents per label, chosen by a hash of the id, are used.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    known = known.groupBy(F.col(key).cast("bigint").alias("doc")).agg((F.max(label) > 0).cast("int").alias("label"))
    total = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    parts = [known.where(F.col("label") == v).orderBy(F.xxhash64("doc"), "doc").limit(SAMPLE) for v in (0, 1)]
    chosen = parts[0].unionByName(parts[1]).withColumn("teach", F.pmod(F.xxhash64(F.lit("part"), "doc"), F.lit(3)) > 0)
    # At most 2 * SAMPLE rows.
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc")
    windows = rows.where("teach").select("doc", "label", "text").mapInArrow(_sample_windows, "doc bigint, label int, text string")
    # One task: the sample is bounded, and a lost executor only repeats it.
    fitted = windows.repartition(1).mapInArrow(_train, "network binary").collect()
    if not fitted:
        return None
    network = pickle.loads(fitted[0]["network"])
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in pieces(batch):
                yield pa.RecordBatch.from_arrays([part.column(1), *(pa.array(c) for c in features(shared.value, data, offsets).T)], ["label", "f0", "f1", "f2"])

    scored = rows.where("NOT teach").select("doc", "label", "text").mapInArrow(run, "label int, f0 double, f1 double, f2 double").collect()
    shared.destroy()
    points = sorted((r["f0"], r["f1"], r["f2"], r["label"]) for r in scored)
    if len({p[3] for p in points}) < 2:
        return Model(network, (0.0, 1.0, 0.0, 0.0))
    table = np.array(points)
    return Model(network, _logistic(table[:, :3], table[:, 3], total[1] / (total[0] + total[1])))


def _logistic(x: np.ndarray, y: np.ndarray, share: float) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps, with labels weighted to their share of all rows."""
    x = np.c_[np.ones(len(x)), x]
    weight = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    beta, ridge = np.zeros(x.shape[1]), np.diag([1e-6, *[0.5] * (x.shape[1] - 1)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge @ beta
        beta = beta + np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, slope)
    return tuple(beta.tolist())


def score(docs: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Null and empty texts, and texts without words, have no window and get the score of
    that. Without a model every score is 0. Repeated rows get equal scores; an empty table
    gives no row. No other column is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part, data, offsets in pieces(batch):
                scores = known.scores(features(known.network, data, offsets)) if known else np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(key).alias("doc_id"), held_out(key).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {key_type(docs, key)}, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents, all columns, without those predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            if known is None:
                yield batch
                continue
            for part, data, offsets in pieces(batch):
                yield part.filter(pa.array(known.scores(features(known.network, data, offsets)) < 0.5))

    return docs.mapInArrow(run, docs.schema)
