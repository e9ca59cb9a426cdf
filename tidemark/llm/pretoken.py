"""Where byte-level BPE splits a text, found without a regular expression.

Every code point becomes one of a few symbols, by its class and its successor. Each
symbol is a function on the states of a small automaton, and functions compose: the
closure of all symbols is a finite monoid whose product table is computed once. A
prefix scan over products gives the state before every code point: chunks are scanned
side by side, their totals are composed in logarithmically many steps, and each chunk
then applies the state it starts with. A table of (state, symbol) says where a slice
begins. The slices are those of the public pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

import numpy as np

LETTER, NUMBER, OTHER, BLANK, SPACE, QUOTE, END = range(7)
# Code points with the property White_Space; fixed values.
WHITE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

# Letters and numbers that version 16.0 of the character tables added to 15.1, as (first, last); fixed values.
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)

# Symbols. Letters differ by what they may do after an apostrophe.
S_LETTER, S_SINGLE, S_FIRST, S_NUMBER, S_OTHER, S_QUOTE, S_INNER, S_LAST, S_SPACE = range(9)
SYMBOLS = 9
# States after a code point.
AT_START, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_BLANKS, AFTER_BLANK, AFTER_SPACE, AFTER_QUOTE, IN_SHORT, AFTER_SHORT = range(10)
STATES = 10
ROWS = 512


@cache
def classes() -> np.ndarray:
    """The class of every code point, by version 16.0 of the character tables, which the libraries have.

    Python's own tables may be of 15.1 or 16.0; with any others slices could differ
    between workers, which is an error.
    """
    if unicodedata.unidata_version not in ("15.1.0", "16.0.0"):
        raise RuntimeError(f"character tables of version {unicodedata.unidata_version}; 15.1 or 16.0 is needed")
    kinds = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
    major = {"L": LETTER, "N": NUMBER}
    for point in range(sys.maxunicode + 1):
        kind = major.get(unicodedata.category(chr(point))[0])
        if kind is not None:
            kinds[point] = kind
    for kind, ranges in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS)):
        for first, last in ranges:
            kinds[first : last + 1] = kind
    kinds[list(WHITE)] = BLANK
    kinds[0x20] = SPACE
    kinds[0x27] = QUOTE
    return kinds


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a slice begins at the symbol."""
    joins = state == AFTER_SPACE
    if symbol in (S_LETTER, S_SINGLE, S_FIRST):
        if state == AFTER_QUOTE and symbol == S_SINGLE or state == IN_SHORT:
            return AFTER_SHORT, False
        if state == AFTER_QUOTE and symbol == S_FIRST:
            return IN_SHORT, False
        return IN_LETTERS, not (joins or state == IN_LETTERS)
    if symbol == S_NUMBER:
        return IN_NUMBERS, not (joins or state == IN_NUMBERS)
    if symbol in (S_OTHER, S_QUOTE):
        if joins or state in (IN_OTHER, AFTER_QUOTE):
            return IN_OTHER, False
        return (AFTER_QUOTE if symbol == S_QUOTE else IN_OTHER), True
    if symbol == S_INNER:
        return IN_BLANKS, state != IN_BLANKS
    return (AFTER_SPACE if symbol == S_SPACE else AFTER_BLANK), True


@cache
def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Product of an element and a symbol, of two elements, elements as functions, begins, symbols.

    Symbols from SYMBOLS on are those at the first code point of a text: they forget
    the state before them.
    """
    begins = np.zeros((STATES, 2 * SYMBOLS), dtype=bool)
    generators = []
    for symbol in range(2 * SYMBOLS):
        steps = [_step(AT_START if symbol >= SYMBOLS else s, symbol % SYMBOLS) for s in range(STATES)]
        begins[:, symbol] = [begin for _, begin in steps]
        generators.append(tuple(state for state, _ in steps))
    identity = tuple(range(STATES))
    found, todo = {identity: 0}, [identity]
    for element in todo:
        for generator in generators:
            product = tuple(generator[s] for s in element)
            if product not in found:
                found[product] = len(found)
                todo.append(product)
    by_symbol = np.array([[found[tuple(g[s] for s in e)] for g in generators] for e in todo], dtype=np.uint16)
    both = np.array([[found[tuple(b[s] for s in a)] for b in todo] for a in todo], dtype=np.uint16)
    return by_symbol, both, np.array(todo, dtype=np.uint8), begins, np.array([found[g] for g in generators], dtype=np.uint16)


def _symbols(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbols of code points; ``first`` are the places where texts begin."""
    kinds = classes()[points]
    after = np.empty_like(kinds)
    after[:-1] = kinds[1:]
    after[-1] = END
    after[first[1:] - 1] = END
    table = np.array([S_LETTER, S_NUMBER, S_OTHER, S_LAST, S_SPACE, S_QUOTE], dtype=np.uint8)
    out = table[kinds]
    blank = (kinds == BLANK) | (kinds == SPACE)
    out[blank & ((after == BLANK) | (after == SPACE) | (after == END))] = S_INNER
    quotes = np.flatnonzero((kinds == QUOTE) & (after == LETTER))
    if len(quotes):
        near = quotes + 1
        one = points[near]
        two = np.where(after[near] == LETTER, points[np.minimum(near + 1, len(points) - 1)], 0)
        r, v, l, e = map(ord, "rvle")
        out[near[np.isin(one, [ord(c) for c in "stmd"])]] = S_SINGLE
        out[near[((one == r) | (one == v)) & (two == e) | (one == l) & (two == l)]] = S_FIRST
    out[first] += SYMBOLS
    return out


def _begins(symbols: np.ndarray) -> np.ndarray:
    """Where slices begin: a prefix scan over the monoid of the symbols."""
    by_symbol, both, functions, begins, _ = _monoid()
    width = 2 * SYMBOLS
    rows = min(ROWS, len(symbols))
    columns = -(-len(symbols) // rows)
    padded = np.zeros(rows * columns, dtype=np.uint8)
    padded[: len(symbols)] = symbols
    grid = np.ascontiguousarray(padded.reshape(columns, rows).T).astype(np.int32)
    flat = by_symbol.ravel().astype(np.int32)
    scan = np.empty((rows, columns), dtype=np.int32)
    element = np.zeros(columns, dtype=np.int32)
    for i in range(rows):
        element = flat[element * width + grid[i]]
        scan[i] = element
    # Totals of the chunks, composed with all chunks before them.
    totals, stride = element.copy(), 1
    while stride < columns:
        totals[stride:] = both[totals[:-stride], totals[stride:]]
        stride *= 2
    entry = np.full(columns, AT_START, dtype=np.int32)
    entry[1:] = functions[totals[:-1], AT_START]
    states = np.empty((rows, columns), dtype=np.int32)
    states[0] = entry
    states[1:] = functions.ravel()[scan[:-1] * STATES + entry]
    out = begins.ravel()[states * width + grid]
    return out.T.ravel()[: len(symbols)]


def slices(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every slice in the bytes, and the text each slice is part of.

    ``offsets`` are where texts begin, and the end of the last. Empty texts have no
    slice.
    """
    filled = np.flatnonzero(np.diff(offsets))
    if not len(filled):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    if len(points) == len(data):
        places = None
        first = offsets[filled]
    else:
        places = np.flatnonzero((data & 0xC0) != 0x80)
        first = np.searchsorted(places, offsets[filled])
    starts = np.flatnonzero(_begins(_symbols(points, first)))
    owner = filled[np.searchsorted(first, starts, side="right") - 1]
    return (starts if places is None else places[starts]), owner
