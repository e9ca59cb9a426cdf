"""Packing documents into windows of a fixed number of tokens, online, by sum of squares.

Each task packs the documents it reads, as they come. A document's whole windows are
sequences of their own. What is left of it is placed by level: a level array holds how
many windows are filled up to each level, and the remainder goes to the level (or a new
window) after which the sum of the squares of these counts is least; of equal choices,
to the fullest window it fits. When the task ends, remainders of the emptiest open
windows are cut to fill the fullest, so each task pads one window at most. Only open
windows are held, a few per level.

Sequence ids are the task's number and a count within the task, so they come out equal
when a lost task runs again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.bytebpe import TokenizerFile
from tidemark.llm.ragged import LEAN, pieces
from tidemark.llm.tokenize import key_type, two_columns

TASK_BITS = 36
COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class Packer:
    """Windows of one task. Pieces are (document, start, ids, tokens of the document)."""

    def __init__(self, capacity: int, first_id: int = 0) -> None:
        self.capacity, self.next_id = capacity, first_id
        self.levels = np.zeros(capacity + 1, dtype=np.int64)
        self.open: dict[int, list[list]] = {}
        self.done: list[tuple] = []

    def add(self, document, ids: np.ndarray) -> None:
        """Pack the ids of one document."""
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            self._emit([(document, start, ids[start : start + self.capacity], len(ids))])
        if whole < len(ids):
            self._place((document, whole, ids[whole:].copy(), len(ids)))

    def best_level(self, size: int) -> int:
        """The level to fill, 0 for a new window: least sum of squared counts afterwards."""
        top = self.capacity - size
        held = self.levels[1 : top + 1]
        after = self.levels[size + 1 :].copy()
        # Change of the sum: one less at the level, one more above it; full windows do not count.
        change = 2 * (after - held) + 2
        if top >= 1:
            change[-1] = 1 - 2 * held[-1]
            change[held == 0] = np.iinfo(np.int64).max
            best = top - int(np.argmin(change[::-1]))
            if change[best - 1] <= 2 * self.levels[size] + 1:
                return best
        return 0

    def _place(self, piece: tuple) -> None:
        size = len(piece[2])
        level = self.best_level(size)
        window = []
        if level:
            window = self.open[level].pop()
            self.levels[level] -= 1
        window.append(piece)
        self._put_back(window, level + size)

    def _put_back(self, window: list, level: int) -> None:
        if level == self.capacity:
            self._emit(window)
        else:
            self.open.setdefault(level, []).append(window)
            self.levels[level] += 1

    def _emit(self, window: list) -> None:
        offset = 0
        for document, start, ids, total in window:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            self.done.append((document, start, len(ids), crc, total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def close(self) -> None:
        """Fill the fullest open windows with what the emptiest hold, and emit all."""
        windows = [[level, w] for level in sorted(self.open) for w in self.open[level]]
        self.open, low, high = {}, 0, len(windows) - 1
        while low < high:
            gap = self.capacity - windows[high][0]
            document, start, ids, total = windows[low][1].pop()
            taken = min(gap, len(ids))
            windows[high][1].append((document, start + len(ids) - taken, ids[len(ids) - taken :], total))
            if taken < len(ids):
                windows[low][1].append((document, start, ids[: len(ids) - taken], total))
            windows[low][0] -= taken
            windows[high][0] += taken
            if windows[high][0] == self.capacity:
                self._emit(windows[high][1])
                high -= 1
            if not windows[low][1]:
                low += 1
        if low == high and windows[low][1]:
            self._emit(windows[low][1])


def pack(docs: DataFrame, tokenizer: TokenizerFile, capacity: int = 1024, end_id: int = 0, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per piece of a document, with its place in a sequence.

    A document's tokens are the ids of its text and then ``end_id``; a null text is
    empty and gives that one token. Pieces of a document are cut at ``start``, its tokens
    before the piece. Sequences hold at most ``capacity`` tokens, gapless from offset 0.
    Repeated rows are packed as often as they occur; an empty table gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer.encoder()
        packer = Packer(capacity, TaskContext.get().partitionId() << TASK_BITS)

        def rows() -> pa.RecordBatch:
            columns = list(zip(*packer.done, strict=True)) or [()] * len(COLUMNS)
            packer.done = []
            arrays = [pa.array(columns[0], kinds[0]), *(pa.array(c, pa.int64()) for c in columns[1:])]
            return pa.RecordBatch.from_arrays(arrays, list(COLUMNS))

        kinds: list = [pa.int64()]
        for batch in batches:
            kinds = [batch.schema.field(0).type]
            for part, data, offsets in pieces(batch, size=LEAN):
                ids, counts = encoder.encode(data, offsets)
                at = 0
                for document, count in zip(part.column(0).to_pylist(), counts.tolist(), strict=True):
                    packer.add(document, np.append(ids[at : at + count], end_id).astype(np.uint32))
                    at += count
                yield rows()
        packer.close()
        if packer.done:
            yield rows()

    schema = f"doc_id {key_type(docs, key)}, " + ", ".join(f"{c} bigint" for c in COLUMNS[1:])
    return two_columns(docs, text, key).mapInArrow(run, schema)
