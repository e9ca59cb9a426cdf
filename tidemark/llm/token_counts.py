"""Token counts by a compiled tokenizer: a deterministic transducer with counts on its transitions.

The machine reads the bytes of a slice from left to right. A state is what the tokens of
the bytes read so far can still do to later ones: for every suffix that begins some
token, the last token before that suffix, and by how much the count there differs from
the count now. Reading a byte picks the one token that ends here and that stands next to
the token before it in a merge of both; the transition then carries how many tokens more
(or fewer) the bytes have. The sum of these along a slice is its number of tokens.
States are compiled when a text first needs them and kept by the worker, up to a bound
after which the machine starts anew; that bounds memory and changes no count.

Slices are found by the composed state maps of `pretoken`: chunks of a text are scanned
side by side, whatever the length of the text, and the machine begins anew at each slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.bytebpe import Encoder, TokenizerFile
from tidemark.llm.ragged import Growing, IntMap, pieces, unique_slices
from tidemark.llm.tokenize import key_type, two_columns

MAX_STATES = 500_000
_BEGIN = -1
_NEVER = 1 << 62
_machines: dict[int, CountTransducer] = {}


class CountTransducer:
    """Number of tokens of slices of bytes.

    A state is a flat tuple: the bytes of the longest suffix that begins a token, then
    (length, token before, difference of counts) for every such suffix.
    """

    def __init__(self, encoder: Encoder) -> None:
        self.encoder = encoder
        self.openings = {token[:n] for token in encoder.token_of for n in range(1, len(token))}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for pair, (rank, made) in encoder.rank_of.items():
            if made not in self.halves or rank < self.halves[made][0]:
                self.halves[made] = rank, pair >> 32, pair & 0xFFFFFFFF
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.alone: dict[int, bool] = {}
        self._restart()

    def _restart(self) -> None:
        self.fits: dict[int, bool] = {}
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.places = IntMap()
        self.target, self.emitted = Growing(np.int32), Growing(np.int32)
        self._number((b"", 0, _BEGIN, 0))

    def _number(self, state: tuple) -> int:
        got = self.numbers.setdefault(state, len(self.states))
        if got == len(self.states):
            self.states.append(state)
        return got

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at one end of a token while it is merged: (token, rank that ends it)."""
        key = token, side
        if key not in self.edges:
            chain, end = [], _NEVER
            while True:
                chain.append((token, end))
                if token not in self.halves:
                    break
                end, *halves = self.halves[token]
                token = halves[side]
            self.edges[key] = chain[::-1]
        return self.edges[key]

    def _begins(self, token: int) -> bool:
        """Whether the bytes of a token, alone, merge to that token."""
        if token not in self.alone:
            self.alone[token] = self.encoder.merge_one(self.encoder.bytes_of[token]) == [token]
        return self.alone[token]

    def _adjacent(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens, side by side, as they are.

        Follows what meets at their border while both are merged: they stay apart if no
        pair across the border comes first. Of equal pairs the left one comes first.
        """
        key = left << 32 | right
        got = self.fits.get(key)
        if got is not None:
            return got
        if not (self._begins(left) and self._begins(right)):
            got = False
        elif self.encoder.whole_first:
            token = self.encoder.bytes_of
            got = self.encoder.merge_one(token[left] + token[right]) == [left, right]
        else:
            a, b, i, j, got = self._edge(left, 1), self._edge(right, 0), 0, 0, True
            while True:
                (x, x_end), (y, y_end) = a[i], b[j]
                across = self.encoder.rank_of.get(x << 32 | y)
                if across is not None and across[0] < x_end and across[0] <= y_end:
                    got = False
                    break
                if x_end == y_end == _NEVER:
                    break
                if x_end <= y_end:
                    i += 1
                else:
                    j += 1
        self.fits[key] = got
        return got

    def _compile(self, number: int, byte: int) -> tuple[int, int]:
        """The state after a byte, and the count its transition carries."""
        state = self.states[number]
        grown = state[0] + bytes((byte,))
        size, made = len(grown), None
        suffixes = [grown[size - 1 - state[i] :] for i in range(1, len(state), 3)]
        for k, suffix in enumerate(suffixes):
            token = self.encoder.token_of.get(suffix)
            if token is not None:
                last = state[3 * k + 2]
                if self._begins(token) if last == _BEGIN else self._adjacent(last, token):
                    made, emitted = token, state[3 * k + 3] + 1
                    break
        if made is None:
            raise ValueError("the vocabulary lacks a byte")
        longest, kept = b"", []
        for k, suffix in enumerate(suffixes):
            if suffix in self.openings:
                longest = longest or suffix
                kept += (len(suffix), state[3 * k + 2], state[3 * k + 3] - emitted)
        return self._number((longest, *kept, 0, made, 0)), emitted

    def _transitions(self, keys: np.ndarray) -> np.ndarray:
        at = self.places.get(keys)
        missing = at < 0
        if missing.any():
            new = np.array(sorted(set(keys[missing].tolist())), dtype=np.uint64)
            made = [self._compile(int(k) >> 8, int(k) & 255) for k in new.tolist()]
            self.places.put(new, np.arange(self.target.size, self.target.size + len(new)))
            self.target.add(np.array([m[0] for m in made], dtype=np.int32))
            self.emitted.add(np.array([m[1] for m in made], dtype=np.int32))
            at = self.places.get(keys)
        return at

    def counts(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of each slice; all slices advance by one byte at a time."""
        if len(self.states) > MAX_STATES:
            self._restart()
        order = np.argsort(-lengths, kind="stable")
        begin, size = starts[order], lengths[order]
        total = np.zeros(len(order), dtype=np.int64)
        state = np.zeros(len(order), dtype=np.uint64)
        # How many slices are longer than each position.
        longer = len(size) - np.searchsorted(size[::-1], np.arange(int(size[0]) if len(size) else 0), side="right")
        for position, active in enumerate(longer.tolist()):
            at = self._transitions(state[:active] << np.uint64(8) | data[begin[:active] + position].astype(np.uint64))
            total[:active] += self.emitted.data[at]
            state[:active] = self.target.data[at]
        out = np.empty_like(total)
        out[order] = total
        return out


def _machine(encoder: Encoder) -> CountTransducer:
    if id(encoder) not in _machines:
        _machines[id(encoder)] = CountTransducer(encoder)
    return _machines[id(encoder)]


def count_texts(machine: CountTransducer, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tokens of each text; special strings of the vocabulary are one token each."""
    starts, lengths, owner, special = machine.encoder.cut(data, offsets)
    if not len(starts):
        return np.zeros(len(offsets) - 1, dtype=np.int64)
    distinct, place = unique_slices(data, starts, lengths)
    counts = machine.counts(data, starts[distinct], lengths[distinct])[place]
    counts[special >= 0] = 1
    return np.bincount(owner, weights=counts, minlength=len(offsets) - 1).astype(np.int64)


def token_counts(docs: DataFrame, tokenizer: TokenizerFile, limit: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: bytes and tokens of the text, and whether it has more tokens than ``limit``.

    A null text is empty: no bytes, no tokens, not over any limit from 0 on. Repeated rows
    give repeated results, an empty table none. Only the two named columns are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(tokenizer.encoder())
        for batch in batches:
            for rows, data, offsets in pieces(batch):
                counts = count_texts(machine, data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.array(counts), pa.array(counts > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    schema = f"doc_id {key_type(docs, key)}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return two_columns(docs, text, key).mapInArrow(run, schema)
