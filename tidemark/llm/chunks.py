"""Substring dedup: passages that stand in an earlier document are cut out of later ones.

A passage is repeated where every window of LEAST_WORDS words in it, compared byte by
byte, stands in a document with a smaller id. Windows are found in two steps. Texts are
cut into chunks where a gear hash of the bytes before a word says so, some ten words on
average, so equal windows are cut alike but for their ends. Chunks meet by digest; only
windows all of whose inner chunks are in several documents can be repeated. The digests
of these windows meet next. They are keys that no shorter repeat can divert: whichever
document is the smallest with a window, it has the whole window. Last, windows are looked
up in that document's text and grown, word by word, to the whole passage both have. One
copy always stays, in the document with the smallest id, and copies within one document
are left alone.

Digests are aggregated to their smallest and largest document and stored before they are
joined to their occurrences, so one that very many documents share is one row on one side
of a join, whose other side is split at run time. Chunks of ten words make the fewest keys:
shorter ones are more and are shared by chance, with longer ones more windows have no inner
chunk and need a key of their own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.llm.joins import BROADCAST_ROWS, narrow_join, stored
from tidemark.llm.ragged import LEAN, pieces, slice_hashes
from tidemark.llm.words import BLANKS, word_places

MEAN_WORDS = 10
GEAR_WINDOW = 16
LEAST_WORDS = 50
_GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)
_BLANK = frozenset(BLANKS)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash of the GEAR_WINDOW bytes that end at each byte."""
    hashes, width = _GEAR[data], 1
    while width < GEAR_WINDOW:
        wider = hashes.copy()
        wider[width:] += hashes[:-width] << np.uint32(width)
        hashes, width = wider, 2 * width
    return hashes


def _cut_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, length and text of every word, and the first word of every chunk."""
    starts, lengths, owner = word_places(data, offsets)
    if not len(starts):
        return starts, lengths, owner, np.zeros(0, dtype=np.int64)
    before = gear_hashes(data)[np.maximum(starts - 1, 0)]
    chosen = ((before * np.uint32(0x9E3779B1)) >> np.uint32(8)) % np.uint32(MEAN_WORDS) == 0
    cut = chosen & (starts - offsets[owner] >= GEAR_WINDOW)
    cut[np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])] = True
    return starts, lengths, owner, np.flatnonzero(cut)


def chunk_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, length, words and text of every chunk; chunks begin at words and end before blanks."""
    starts, lengths, owner, first = _cut_words(data, offsets)
    words = np.diff(np.r_[first, len(starts)])
    last = first + words - 1
    return starts[first], starts[last] + lengths[last] - starts[first], words, owner[first]


def window_digests(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashes of the bytes of the windows that begin at these words."""
    last = first + LEAST_WORDS - 1
    return slice_hashes(data, starts[first], starts[last] + lengths[last] - starts[first]).astype(np.int64)


def keys_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Digest, text, place and reach of every chunk, and of every window without an inner chunk.

    An inner chunk of a window is one whose both ends follow from bytes of the window, so
    that it is a chunk wherever the window stands. The place is the first word in the text,
    shifted, and the number of words, which is 0 for a window. The reach has how many words
    before the chunk a window may begin, shifted, and how many after it a window may end,
    so that the neighbouring chunk is no inner one.
    """
    starts, lengths, owner, first = _cut_words(data, offsets)
    count = len(starts)
    if not count:
        return (np.zeros(0, dtype=np.int64),) * 4
    base = np.searchsorted(owner, np.arange(len(offsets) - 1))
    ends = np.searchsorted(owner, np.arange(len(offsets) - 1), side="right")
    text = owner[first]
    words = np.diff(np.r_[first, count])
    digests = slice_hashes(data, starts[first], starts[first + words - 1] + lengths[first + words - 1] - starts[first]).astype(np.int64)
    same = text[1:] == text[:-1]
    left, ahead = np.zeros(len(first), dtype=np.int64), np.zeros(len(first), dtype=np.int64)
    left[1:] = np.where(same, first[1:] - np.maximum(base[text[1:]], np.searchsorted(starts, starts[first[:-1]] - GEAR_WINDOW, side="right")), 0)
    ahead[:-1] = np.where(same, words[1:], 0)
    reach = np.minimum(left, LEAST_WORDS) << 8 | np.minimum(ahead, LEAST_WORDS)
    place = (first - base[text]) << 32 | words
    window = np.flatnonzero(np.arange(count) + LEAST_WORDS <= ends[owner])
    inner = np.searchsorted(starts[first], starts[window] + GEAR_WINDOW)
    window = window[np.r_[first, count, count][inner + 1] > window + LEAST_WORDS - 1]
    zeros = np.zeros(len(window), dtype=np.int64)
    return (
        np.r_[digests, window_digests(data, starts, lengths, window)], np.r_[text, owner[window]],
        np.r_[place, (window - base[owner[window]]) << 32], np.r_[reach, zeros],
    )


def _occurrences(docs: DataFrame) -> DataFrame:
    """(digest, doc, mark, place, reach) of every key; mark tells texts of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in pieces(batch, size=LEAN):
                digests, owner, place, reach = keys_of(data, offsets)
                ids = rows.column(0).take(pa.array(owner))
                raw = memoryview(data.tobytes())
                marks = np.array([zlib.crc32(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests), ids, pa.array(marks[owner]), pa.array(place), pa.array(reach.astype(np.int32))],
                    ["digest", "doc", "mark", "place", "reach"],
                )

    return docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, "digest bigint, doc bigint, mark bigint, place bigint, reach int")


def _lists(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """The row of every struct in a column of lists, and its fields."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten()
    return np.repeat(np.arange(len(column)), sizes), [f.to_numpy(zero_copy_only=False) for f in flat.flatten()]


def windows_of(row: np.ndarray, place: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last of the stretches of windows whose inner chunks are all among those given."""
    order = np.lexsort((place, row))
    row, place, reach = row[order], place[order], reach[order]
    at, words = place >> 32, place & 0xFFFFFFFF
    alone, chunk = words == 0, words > 0
    r, a, w, left, ahead = row[chunk], at[chunk], words[chunk], reach[chunk] >> 8, reach[chunk] & 0xFF
    breaks = (r[1:] != r[:-1]) | (a[1:] != a[:-1] + w[:-1])
    begin, end = np.flatnonzero(np.r_[np.ones(min(1, len(r)), dtype=bool), breaks]), np.flatnonzero(np.r_[breaks, np.ones(min(1, len(r)), dtype=bool)])
    low, high = a[begin] - left[begin], a[end] + w[end] + ahead[end] - LEAST_WORDS
    some = low <= high
    return np.r_[r[begin][some], row[alone]], np.r_[low[some], at[alone]], np.r_[high[some], at[alone]]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with windows that may be repeated, and where these are."""
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    for batch in batches:
        row, first, last = windows_of(*(lambda row, fields: (row, *fields))(*_lists(batch.column(2))))
        order = np.argsort(row, kind="stable")
        kept, sizes = np.unique(row, return_counts=True)
        held = pa.StructArray.from_arrays([pa.array(first[order]), pa.array(last[order])], names=["first", "last"])
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), held)
        yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(kept)) for i in (0, 1)), lists.cast(kind)], ["doc", "mark", "windows"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, doc, mark, at) of the windows that may be repeated; ``at`` is the first word."""
    for batch in batches:
        for rows, data, offsets in pieces(batch, size=LEAN):
            starts, lengths, owner = word_places(data, offsets)
            base, ends = (np.searchsorted(owner, np.arange(rows.num_rows), side=s) for s in ("left", "right"))
            row, (first, last) = _lists(rows.column(2))
            chosen = np.zeros(len(starts) + 1, dtype=np.int64)
            low, high = base[row] + first, np.minimum(base[row] + last, ends[row] - LEAST_WORDS)
            some = low <= high
            np.add.at(chosen, low[some], 1)
            np.subtract.at(chosen, high[some] + 1, 1)
            at = np.flatnonzero(np.cumsum(chosen[:-1]) > 0)
            text = pa.array(owner[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(window_digests(data, starts, lengths, at)), rows.column(0).take(text), rows.column(1).take(text), pa.array(at - base[owner[at]])],
                ["digest", "doc", "mark", "at"],
            )


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of neighbouring windows of one text that one earlier document is to have."""
    for batch in batches:
        row, (at, keeper) = _lists(batch.column(2))
        order = np.lexsort((at, row))
        row, at, keeper = row[order], at[order], keeper[order]
        breaks = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1) | (keeper[1:] != keeper[:-1])
        edge = np.ones(min(1, len(row)), dtype=bool)
        begin, end = np.flatnonzero(np.r_[edge, breaks]), np.flatnonzero(np.r_[breaks, edge])
        text = pa.array(row[begin])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(text), batch.column(1).take(text), pa.array(at[begin]), pa.array(at[end]), pa.array(keeper[begin])],
            ["doc", "mark", "first", "last", "keeper"],
        )


def grown(own: np.ndarray, other: np.ndarray, stretches: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, length, words) of the passages around windows that stand in the other text too.

    A stretch is the first word of its first and of its last window. Each window is looked
    up by itself unless a passage found before covers it, so windows may stand at any places.
    """
    starts, lengths, _ = word_places(own, np.array([0, len(own)]))
    ends, raw, hay, out, done = starts + lengths, own.tobytes(), other.tobytes(), [], 0
    blank = lambda text, i: not 0 <= i < len(text) or text[i] in _BLANK
    for first, last in sorted(stretches):
        window = max(first, done)
        while window <= last:
            start, end = int(starts[window]), int(ends[window + LEAST_WORDS - 1])
            at = hay.find(raw[start:end])
            while at >= 0 and not (blank(hay, at - 1) and blank(hay, at + end - start)):
                at = hay.find(raw[start:end], at + 1)
            window += 1
            if at < 0:
                continue
            move, back = at - start, min(start, at)
            differ = np.flatnonzero(own[start - back : start] != other[at - back : at])
            left = start - back + (int(differ[-1]) + 1 if len(differ) else 0)
            ahead = min(len(own) - end, len(other) - end - move)
            differ = np.flatnonzero(own[end : end + ahead] != other[end + move : end + move + ahead])
            right = end + (int(differ[0]) if len(differ) else ahead)
            # Begin and end between words of both texts.
            while left < start and not (blank(raw, left - 1) and blank(hay, left - 1 + move)) and not blank(raw, left):
                left += 1
            # Blanks before the passage stay, unless the text begins with them: they part what is left.
            while 0 < left < start and blank(raw, left):
                left += 1
            while right > end and not (blank(raw, right) and blank(hay, right + move)) and not blank(raw, right - 1):
                right -= 1
            covered = int(np.searchsorted(ends, right, side="right"))
            out.append((left, right - left, covered - int(np.searchsorted(starts, left))))
            # The first window that ends behind the passage.
            window = done = covered - LEAST_WORDS + 1
    return out


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages that pairs of texts share, from the seeds of each pair."""
    names = ["doc", "mark", "start", "size", "keeper", "words"]
    for batch in batches:
        out = []
        for r in range(batch.num_rows):
            doc, mark, keeper, seeds = (batch.column(i)[r].as_py() for i in range(4))
            own, other = (np.frombuffer(batch.column(i)[r].as_buffer(), dtype=np.uint8) for i in (4, 5))
            out += [(doc, mark, a, n, keeper, w) for a, n, w in grown(own, other, [(s["first"], s["last"]) for s in seeds])]
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _several(keys: DataFrame) -> DataFrame:
    """Digests that several documents have, with the smallest of these, as a stored table.

    Straight from the aggregate the join would take over its partitions, which are not split.
    """
    found = keys.groupBy("digest").agg(F.min("doc").alias("keeper"), F.max("doc").alias("last"))
    return stored(found.where("keeper < last").select("digest", "keeper"), "shared")


def repeated_passages(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc, mark, spans) of every text that repeats a passage of an earlier document.

    ``spans`` are (start, size, keeper, words), in bytes of the text; spans may overlap.
    ``mark`` is the text's CRC-32, which tells texts apart that share an id; these do not
    count as different documents. Nulls in text or id repeat nothing. An empty table gives
    no row.
    """
    docs = docs.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    several = _several(_occurrences(docs)).select("digest")
    shared = _occurrences(docs).join(several, "digest").groupBy("doc", "mark").agg(F.collect_set(F.struct("place", "reach")).alias("found"))
    texts = docs.select(F.col("doc_id").alias("doc"), F.crc32(F.col("text").cast("binary")).alias("mark"), "text")
    held = stored(shared.mapInArrow(_stretches, "doc bigint, mark bigint, windows array<struct<first:bigint,last:bigint>>"), "stretches")
    most = held.agg(F.coalesce(F.sum(F.size("windows")), F.lit(0))).first()[0]
    near = narrow_join(texts, held, ["doc", "mark"], most=most).select("doc", "mark", "windows", "text")
    windows = stored(near.mapInArrow(_windows, "digest bigint, doc bigint, mark bigint, at bigint"), "windows")
    again = windows.join(_several(windows), "digest").where("doc > keeper")
    by_text = again.groupBy("doc", "mark").agg(F.collect_set(F.struct("at", "keeper")).alias("found"))
    seeds = stored(by_text.mapInArrow(_seeds, "doc bigint, mark bigint, first bigint, last bigint, keeper bigint"), "seeds")
    most = seeds.count()
    own = narrow_join(texts.withColumnRenamed("text", "own"), seeds.select("doc", "mark").distinct(), ["doc", "mark"], "left_semi", most).dropDuplicates(["doc", "mark"])
    other = docs.select(F.col("doc_id").alias("keeper"), F.col("text").alias("other"))
    other = narrow_join(other, seeds.select("keeper").distinct(), "keeper", "left_semi", most).distinct()
    # One row per pair of texts, so that each text travels once for all seeds of the pair.
    pairs = seeds.groupBy("doc", "mark", "keeper").agg(F.collect_list(F.struct("first", "last")).alias("seeds"))
    met = pairs.join(own, ["doc", "mark"]).join(other, "keeper").select("doc", "mark", "keeper", "seeds", "own", "other")
    spans = met.mapInArrow(_grow, "doc bigint, mark bigint, start bigint, size bigint, keeper bigint, words bigint").distinct()
    return stored(spans.groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "size", "keeper", "words")).alias("spans")), "spans")


def cut_text(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans, and without the blanks after a span that follows a blank."""
    out, at = [], 0
    for start, size in sorted(spans):
        end = start + size
        if end <= at:
            continue
        out.append(text[at : max(start, at)])
        at = end
        if start == 0 or text[start - 1] in _BLANK:
            while at < len(text) and text[at] == 0x20:
                at += 1
    out.append(text[at:])
    return b"".join(out)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the text column by the text without the spans in the last column."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = [
            t if not s else cut_text(t.encode(), [(x["start"], x["size"]) for x in s]).decode()
            for t, s in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True)
        ]
        arrays = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns[:-1])]
        yield pa.RecordBatch.from_arrays(arrays, batch.schema.names[:-1])


def _free(name: str, columns: list[str]) -> str:
    """The name, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def _with_spans(docs: DataFrame, spans: DataFrame, how: str) -> tuple[DataFrame, str]:
    """All columns of the documents and the spans of each, under a name that no column has."""
    doc, mark, name = (_free(n, docs.columns) for n in ("_doc", "_mark", "_spans"))
    held = spans.select(F.col("doc").alias(doc), F.col("mark").alias(mark), F.col("spans").alias(name))
    total = spans.agg(F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()[0]
    on = (F.col("doc_id") == F.col(doc)) & (F.crc32(F.col("text").cast("binary")) == F.col(mark))
    return docs.join(F.broadcast(held) if total <= BROADCAST_ROWS else held, on, how).drop(doc, mark), name


def dedup(docs: DataFrame) -> DataFrame:
    """The documents, all columns and rows, with repeated passages cut out of ``text``.

    ``n_chars``, where there is such a column, becomes the length of the text left. A text
    that is all repeated becomes empty, not null. Other columns may have any names.
    """
    # Plain names on the way through Python, which takes no name with a dot.
    names = [c if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)]
    kind = StructType([StructField(n, f.dataType) for n, f in zip(names, docs.schema, strict=True)])
    joined = _with_spans(docs, repeated_passages(docs), "left")[0].toDF(*names, "spans")
    out = joined.mapInArrow(_cut, kind).toDF(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def repeats(docs: DataFrame) -> DataFrame:
    """One row per document that repeats a passage: what is cut, where it is kept, what is left.

    ``removed`` has (start, size) in bytes, ``kept_in`` the documents that keep a copy.
    """
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    joined, name = _with_spans(plain, repeated_passages(plain), "inner")
    removed = F.array_sort(F.transform(name, lambda s: F.struct(s["start"].alias("start"), s["size"].alias("size"))))
    rows = joined.select(
        "doc_id", F.array_sort(F.array_distinct(F.col(f"{name}.keeper"))).alias("kept_in"), removed.alias("removed"),
        F.col("text"), name,
    )
    kind = "doc_id bigint, kept_in array<bigint>, removed array<struct<start:bigint,size:bigint>>, text string"
    return rows.mapInArrow(_cut, kind)
