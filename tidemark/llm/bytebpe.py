"""Byte-level BPE: vocabularies, merging of many slices side by side, encoding, decoding."""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
from dataclasses import dataclass

import numpy as np

from tidemark.llm import pretoken
from tidemark.llm.ragged import Growing, IntMap, flat_index, slice_hashes

LONG = 200
CACHE_SLICES = 1_000_000
_NEVER = np.int64(1) << 62
_loaded: dict[str, Encoder] = {}


@dataclass(frozen=True)
class TokenizerFile:
    """Content of a vocabulary file, as the driver read it; the size of the file bounds it."""

    content: bytes
    kind: str

    @staticmethod
    def read(path: str) -> TokenizerFile:
        with open(path, "rb") as file:
            return TokenizerFile(file.read(), "json" if path.endswith(".json") else "tiktoken")

    def encoder(self) -> Encoder:
        """The encoder of this file, kept by each Python worker."""
        name = hashlib.sha256(self.content).hexdigest()
        if name not in _loaded:
            _loaded[name] = Encoder(self)
        return _loaded[name]


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes: printable ones for themselves, others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class SliceCache:
    """Slices with their ids, found by hash."""

    def __init__(self) -> None:
        self.places = IntMap()
        self.bytes = Growing(np.uint8)
        self.starts, self.lengths = Growing(np.int64), Growing(np.int64)
        self.ids = Growing(np.int32)
        self.first, self.counts = Growing(np.int64), Growing(np.int64)

    def __len__(self) -> int:
        return self.starts.size

    def find(self, hashes: np.ndarray) -> np.ndarray:
        return self.places.get(hashes)

    def add(self, hashes: np.ndarray | None, cut: list[bytes], ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Entries of new slices; without hashes they are not found again."""
        entries = np.arange(len(self), len(self) + len(cut))
        if hashes is not None:
            self.places.put(hashes, entries)
        lengths = np.array([len(c) for c in cut], dtype=np.int64)
        self.starts.add(self.bytes.size + np.cumsum(lengths) - lengths)
        self.lengths.add(lengths)
        self.bytes.add(np.frombuffer(b"".join(cut), dtype=np.uint8))
        self.first.add(self.ids.size + np.cumsum(counts) - counts)
        self.counts.add(counts)
        self.ids.add(ids)
        return entries

    def differing(self, entry: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Slices, which together are the data, that are not equal to their entries."""
        differs = self.lengths.data[entry] != lengths
        held = self.bytes.data[np.minimum(flat_index(self.starts.data[entry], lengths), self.bytes.size - 1)]
        unequal = np.flatnonzero(held != data)
        if len(unequal):
            differs[np.searchsorted(np.cumsum(lengths), unequal, side="right")] = True
        return np.flatnonzero(differs)


class Encoder:
    """Ids of texts by the merges of one vocabulary."""

    def __init__(self, file: TokenizerFile) -> None:
        self.special: dict[bytes, int] = {}
        if file.kind == "json":
            self._from_json(json.loads(file.content))
        else:
            self._from_ranks(file.content)
        size = max(self.token_of.values(), default=0) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, number in self.token_of.items():
            self.bytes_of[number] = token
        self.size = size
        self.of_byte = np.array([self.token_of[bytes([b])] for b in range(256)], dtype=np.int64)
        self.rank_of = dict(zip(self._pair_keys.tolist(), zip(self._pair_ranks.tolist(), self._pair_ids.tolist(), strict=True), strict=True))
        self.pairs = IntMap()
        self.pairs.put(self._pair_keys, np.arange(len(self._pair_keys)))
        self.token_lengths = np.array([len(t) for t in self.bytes_of], dtype=np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(self.bytes_of), dtype=np.uint8)
        self.cache = SliceCache()

    def _from_ranks(self, content: bytes) -> None:
        self.token_of = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) }
        self.whole_first = True
        keys, ranks = [], []
        for token, rank in self.token_of.items():
            for cut in range(1, len(token)):
                left, right = self.token_of.get(token[:cut]), self.token_of.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ranks.append(rank)
        self._pair_keys = np.array(keys, dtype=np.uint64)
        self._pair_ranks = self._pair_ids = np.array(ranks, dtype=np.int64)

    def _from_json(self, model: dict) -> None:
        letters = _byte_letters()
        self.special = {t["content"].encode(): t["id"] for t in model["added_tokens"]}
        names = {t["content"] for t in model["added_tokens"]}
        vocabulary = model["model"]["vocab"]
        self.token_of = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if t not in names}
        self.whole_first = False
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self._pair_keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in merges], dtype=np.uint64)
        self._pair_ranks = np.arange(len(merges), dtype=np.int64)
        self._pair_ids = np.array([vocabulary[a + b] for a, b in merges], dtype=np.int64)

    # Merging

    def merge_one(self, piece: bytes) -> list[int]:
        """Ids of one slice, by a queue of its pairs; for long slices."""
        symbols = self.of_byte[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(symbols)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            got = self.rank_of.get(symbols[i] << 32 | symbols[i + 1])
            if got:
                queue.append((got[0], i, symbols[i], symbols[i + 1], got[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, made = heapq.heappop(queue)
            j = following[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = made, -1
            following[i] = k = following[j]
            if k < n:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b < n and (got := self.rank_of.get(symbols[a] << 32 | symbols[b])):
                    heapq.heappush(queue, (got[0], a, symbols[a], symbols[b], got[1]))
        return [s for s in symbols if s >= 0]

    def _orders(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place in the merge table of each pair, -1 for pairs that never merge."""
        return self.pairs.get(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64))

    def merge_many(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number per slice, for slices that lie one after another."""
        counts = np.zeros(len(lengths), dtype=np.int64)
        done_of, done_ids = [], []
        symbols, owner = self.of_byte[data], np.repeat(np.arange(len(lengths)), lengths)
        at = np.full(len(symbols), -1, dtype=np.int64)
        inside = np.flatnonzero(owner[:-1] == owner[1:]) if len(owner) else owner
        at[inside] = self._orders(symbols[inside], symbols[inside + 1])
        ranks = np.where(at >= 0, self._pair_ranks[np.maximum(at, 0)], _NEVER >> 32)
        while len(symbols):
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(ranks << 32 | np.arange(len(ranks)), heads)
            open_ = best >> 32 < _NEVER >> 32
            if not open_.all():
                keep = np.repeat(open_, np.diff(np.r_[heads, len(owner)]))
                done_of.append(owner[~keep])
                done_ids.append(symbols[~keep])
                if not keep.any():
                    break
                moved = np.cumsum(keep) - 1
                best = moved[best[open_] & 0xFFFFFFFF]
                symbols, owner, at, ranks = symbols[keep], owner[keep], at[keep], ranks[keep]
            else:
                best = best & 0xFFFFFFFF
            symbols[best] = self._pair_ids[at[best]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[best + 1] = False
            spot = best - np.arange(len(best))
            symbols, owner, at, ranks = symbols[keep], owner[keep], at[keep], ranks[keep]
            near = np.zeros(len(symbols), dtype=bool)
            near[spot] = near[np.maximum(spot - 1, 0)] = True
            touched = np.flatnonzero(near)
            follows = (touched + 1 < len(symbols)) & (owner[touched] == owner[np.minimum(touched + 1, len(symbols) - 1)])
            at[touched[~follows]], ranks[touched[~follows]] = -1, _NEVER >> 32
            touched = touched[follows]
            new = self._orders(symbols[touched], symbols[touched + 1])
            at[touched] = new
            ranks[touched] = np.where(new >= 0, self._pair_ranks[np.maximum(new, 0)], _NEVER >> 32)
        owners = np.concatenate(done_of) if done_of else np.zeros(0, dtype=np.int64)
        ids = np.concatenate(done_ids) if done_ids else np.zeros(0, dtype=np.int64)
        order = np.argsort(owners, kind="stable")
        np.add.at(counts, owners, 1)
        return ids[order], counts

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all slices, slice after slice, and their number per slice."""
        known = [self.token_of.get(p) for p in pieces] if self.whole_first else [None] * len(pieces)
        short = [i for i, p in enumerate(pieces) if known[i] is None and len(p) <= LONG]
        ids, counts = self.merge_many(
            np.frombuffer(b"".join(pieces[i] for i in short), dtype=np.uint8),
            np.array([len(pieces[i]) for i in short], dtype=np.int64),
        )
        if len(short) == len(pieces):
            return ids, counts
        out: list = [None] * len(pieces)
        for i, part in zip(short, np.split(ids, np.cumsum(counts)[:-1]), strict=True) if short else ():
            out[i] = part
        for i, piece in enumerate(pieces):
            if out[i] is None:
                out[i] = np.array(self.merge_one(piece) if known[i] is None else [known[i]], dtype=np.int64)
        return np.concatenate(out), np.array([len(x) for x in out], dtype=np.int64)

    # Texts

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Slices of texts: start, length, text, and the id of a special string or -1."""
        spans = []
        raw = data.tobytes() if self.special else b""
        for string, number in self.special.items():
            at = raw.find(string)
            while at >= 0:
                inside = np.searchsorted(offsets, at, side="right")
                if at + len(string) <= offsets[inside]:
                    spans.append((at, at + len(string), number))
                    at = raw.find(string, at + len(string))
                else:
                    at = raw.find(string, at + 1)
        if not spans:
            starts, owner = pretoken.slices(data, offsets)
            return starts, _lengths(starts, len(data)), owner, np.full(len(starts), -1, dtype=np.int64)
        bounds = np.unique(np.concatenate([offsets, [s[0] for s in spans], [s[1] for s in spans]]))
        starts, part = pretoken.slices(data, bounds)
        special = np.full(len(starts), -1, dtype=np.int64)
        lengths = _lengths(starts, len(data))
        keep = np.ones(len(starts), dtype=bool)
        for begin, end, number in spans:
            inside = np.flatnonzero((starts >= begin) & (starts < end))
            special[inside[0]], lengths[inside[0]] = number, end - begin
            keep[inside[1:]] = False
        owner = np.searchsorted(offsets, starts, side="right") - 1
        return starts[keep], lengths[keep], owner[keep], special[keep]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, text after text, and the number of ids of each text.

        Slices are looked up in a bounded cache by hash and compared byte by byte with
        what they met; distinct slices that are not there are merged side by side.
        """
        starts, lengths, owner, special = self.cut(data, offsets)
        if not len(starts):
            return np.zeros(0, dtype=np.int64), np.zeros(len(offsets) - 1, dtype=np.int64)
        cache = self.cache
        if len(cache) > CACHE_SLICES:
            cache = self.cache = SliceCache()
        hashes = slice_hashes(data, starts, lengths)
        entry = cache.find(hashes)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            raw = data.tobytes()
            first = missing[np.unique(hashes[missing], return_index=True)[1]]
            cut = [raw[s : s + n] for s, n in zip(starts[first].tolist(), lengths[first].tolist(), strict=True)]
            cache.add(hashes[first], cut, *self.merge(cut))
            entry[missing] = cache.find(hashes[missing])
        wrong = cache.differing(entry, data, lengths)
        if len(wrong):
            raw = data.tobytes()
            cut = [raw[s : s + n] for s, n in zip(starts[wrong].tolist(), lengths[wrong].tolist(), strict=True)]
            entry[wrong] = cache.add(None, cut, *self.merge(cut))
        counts, first = cache.counts.data[entry], cache.first.data[entry]
        marked = special >= 0
        if marked.any():
            counts[marked] = 1
        ids = cache.ids.data[flat_index(first, counts)]
        if marked.any():
            ids[(np.cumsum(counts) - counts)[marked]] = special[marked]
        return ids, np.bincount(owner, weights=counts, minlength=len(offsets) - 1).astype(np.int64)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of ids; the bytes of each id lie one after another."""
        return self.token_bytes[flat_index(self.token_starts[ids], self.token_lengths[ids])]


def _lengths(starts: np.ndarray, end: int) -> np.ndarray:
    return np.diff(np.r_[starts, end])
