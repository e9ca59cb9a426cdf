"""Byte-level BPE encoding and decoding of text columns.

Texts are split into slices by class scans (`pretoken`), slices are merged through a
cache (`bytebpe`). Work is per row, in Arrow batches, without any shuffle. A null text
is an empty text: no ids, empty bytes. Texts of any length are taken whole. Repeated
rows give repeated results. Only the named columns are read, so others may be called
anything. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytebpe import TokenizerFile
from tidemark.llm.ragged import pieces


def two_columns(docs: DataFrame, text: str, key: str) -> DataFrame:
    """The key and the text, and nothing else of the table."""
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))


def key_type(docs: DataFrame, key: str) -> str:
    return docs.schema[key].dataType.simpleString()


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values.astype(np.int32)))


def encode(docs: DataFrame, tokenizer: TokenizerFile, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: ``ids`` of the text, and ``ends``, the byte of the text where each id ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer.encoder()
        for batch in batches:
            for rows, data, offsets in pieces(batch):
                ids, counts = encoder.encode(data, offsets)
                ends = np.cumsum(encoder.token_lengths[ids]) - np.repeat(offsets[:-1], counts)
                yield pa.RecordBatch.from_arrays([rows.column(0), _lists(ids, counts), _lists(ends, counts)], ["doc_id", "ids", "ends"])

    return two_columns(docs, text, key).mapInArrow(run, f"doc_id {key_type(docs, key)}, ids array<int>, ends array<int>")


def decode(encoded: DataFrame, tokenizer: TokenizerFile, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """Per row the ``bytes`` of the ids; bytes, because ids may end inside a character.

    Null ids decode to no bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer.encoder()
        for batch in batches:
            lists = batch.column(1)
            counts = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], dtype=np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(counts)), counts)
            sizes = np.bincount(row, weights=encoder.token_lengths[flat], minlength=len(counts)).astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            data = encoder.decode(flat).tobytes()
            out = pa.array([data[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), out], ["doc_id", "bytes"])

    rows = encoded.select(F.col(key).alias("doc_id"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, f"doc_id {key_type(encoded, key)}, bytes binary")


def round_trip(docs: DataFrame, tokenizer: TokenizerFile, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode, then decode the ids, in one pass: number of ids and digests of ids and bytes.

    ``ids_sha256`` is over the ids as little-endian unsigned 32-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer.encoder()
        for batch in batches:
            for rows, data, offsets in pieces(batch):
                ids, counts = encoder.encode(data, offsets)
                decoded = memoryview(encoder.decode(ids).tobytes())
                bounds = np.concatenate([[0], np.cumsum(counts)])
                sums = np.concatenate([[0], np.cumsum(encoder.token_lengths[ids])])[bounds].tolist()
                words, at = memoryview(ids.astype("<u4").tobytes()), (4 * bounds).tolist()
                digest = lambda view, cuts: [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(counts), pa.array(digest(words, at), pa.string()), pa.array(digest(decoded, sums), pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = f"doc_id {key_type(docs, key)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return two_columns(docs, text, key).mapInArrow(run, schema)
