"""Vectorised helpers on ragged byte slices, shared by the tasks of several operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_KEYS = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}

# Bytes of text at a time where many numbers are held for every byte; a worker rarely gives back what its largest piece took.
LEAN = 1 << 18


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on all input bits."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def flat_index(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all elements of the slices, slice after slice."""
    lengths = np.asarray(lengths, dtype=np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(np.asarray(starts, dtype=np.int64) - (ends - lengths), lengths) + np.arange(total)


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse, modulo 2^64."""
    if len(_powers.get("up", ())) < count:
        size = 1 << max(16, (count - 1).bit_length())
        for name, base in (("up", _ODD), ("down", _INVERSE)):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"][:count], _powers["down"][:count]


def slice_hashes(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash per slice of bytes, or of 64-bit values that are hashes already."""
    keys = _BYTE_KEYS[values] if values.dtype == np.uint8 else values.astype(np.uint64, copy=False)
    up, down = powers(len(keys) + 1)
    sums = np.zeros(len(keys) + 1, dtype=np.uint64)
    np.cumsum(keys * up[:-1], out=sums[1:])
    hashes = (sums[starts + lengths] - sums[starts]) * down[starts]
    return mix(hashes + np.asarray(lengths).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def unique_slices(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of one slice per distinct content, and each slice's place among these.

    Slices meet by hash; every slice is then compared with the one it met, byte by
    byte, and those that differ stand for themselves.
    """
    _, first, place = np.unique(slice_hashes(data, starts, lengths), return_index=True, return_inverse=True)
    met = first[place]
    differs = lengths != lengths[met]
    probe = np.flatnonzero(~differs & (met != np.arange(len(met))))
    if len(probe):
        odd = data[flat_index(starts[probe], lengths[probe])] != data[flat_index(starts[met[probe]], lengths[probe])]
        if odd.any():
            differs[np.repeat(probe, lengths[probe])[odd]] = True
    alone = np.flatnonzero(differs)
    place[alone] = len(first) + np.arange(len(alone))
    return np.concatenate([first, alone]), place


class IntMap:
    """A hash table from 64-bit keys to non-negative 32-bit values, on whole arrays."""

    def __init__(self, bits: int = 12) -> None:
        self.bits, self.count = bits, 0
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.values = np.full(1 << bits, -1, dtype=np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _ODD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, -1 where there is none."""
        keys = keys.astype(np.uint64, copy=False)
        slots = self._slots(keys)
        out = self.values[slots]
        wrong = np.flatnonzero((out >= 0) & (self.keys[slots] != keys))
        while len(wrong):
            slots[wrong] = (slots[wrong] + 1) & ((1 << self.bits) - 1)
            found = self.values[slots[wrong]]
            out[wrong] = found
            wrong = wrong[(found >= 0) & (self.keys[slots[wrong]] != keys[wrong])]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys that are distinct and not in the table yet."""
        keys, values = keys.astype(np.uint64, copy=False), np.asarray(values, dtype=np.int32)
        if 2 * (self.count + len(keys)) > len(self.keys):
            held = self.values >= 0
            old = self.keys[held], self.values[held]
            self.__init__(max(self.bits + 1, int(2 * (self.count + len(keys)) - 1).bit_length()))
            self.put(*old)
        self.count += len(keys)
        slots, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = left[self.values[slots[left]] < 0]
            self.keys[slots[free]] = keys[free]
            won = free[self.keys[slots[free]] == keys[free]]
            self.values[slots[won]] = values[won]
            placed = np.zeros(len(keys), dtype=bool)
            placed[won] = True
            left = left[~placed[left]]
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)


class Growing:
    """An array that grows at its end."""

    def __init__(self, kind: type) -> None:
        self._held, self.size = np.zeros(1024, dtype=kind), 0

    @property
    def data(self) -> np.ndarray:
        return self._held[: self.size]

    def add(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self._held):
            grown = np.zeros(max(self.size + len(values), 3 * len(self._held) // 2), dtype=self._held.dtype)
            grown[: self.size] = self.data
            self._held = grown
        self._held[self.size : self.size + len(values)] = values
        self.size += len(values)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, and the offset of each row; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(batch: pa.RecordBatch, text: str = "text", size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``size`` bytes of text, one row at least, with bytes and offsets."""
    data, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1)
        stop = min(stop, batch.num_rows)
        yield batch.slice(start, stop - start), data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop
