"""Words and word windows of many texts at once, as places in their bytes.

Words are runs of anything but the six ASCII blanks. Windows are compared by 64-bit
hashes of their words' 64-bit hashes.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.ragged import slice_hashes

BLANKS = (0x20, *range(0x09, 0x0E))
_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(BLANKS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of every word, and the text it is in."""
    inside = ~_BLANK[data]
    opens, ends = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = offsets[:-1][np.diff(offsets) > 0]
    opens[filled] = inside[filled]
    last = filled[1:] - 1
    ends[last] = inside[last]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(ends) + 1 - starts, np.searchsorted(offsets, starts, side="right") - 1


def window_places(counts: np.ndarray, size: int) -> np.ndarray:
    """First word of every window of ``size`` words that lies in one text."""
    ends = np.cumsum(counts)
    word = np.arange(int(ends[-1]) if len(ends) else 0)
    return word[word + size <= np.repeat(ends, counts)]


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text are flagged."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def window_hashes(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    return slice_hashes(hashes, first, np.full(len(first), size, dtype=np.int64))
