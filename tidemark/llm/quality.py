"""Quality rules: statistics of a text, and robust outliers among those of its group.

Documents of one language and source make a group; those of a group with too few usable
documents are judged by the estimate of all documents of their language, and if these are
too few as well, of all documents. Every statistic is a rate; its deviation from the median
of the whole table is divided by the pooled robust spread and the noise of counting, as a
rate of few words or lines varies by chance. So a unit is what chance explains, in short
texts and long, and no variance counts below one unit. A group's centre and covariance are
its minimum-covariance-determinant estimate: from three starts, steps each keep the three
quarters of the documents with the least Mahalanobis distance and estimate anew from
these; the start that came to the least determinant is taken, and all documents within the
usual distance count once more. Documents beyond a quantile of the chi-square law are
rejected. All documents take part: quantiles
and moments are aggregates that combine before their shuffle, so a group may hold any
share of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ragged import LEAN, mix, pieces, slice_hashes
from tidemark.llm.tokenize import key_type
from tidemark.llm.words import per_text, window_hashes, window_places, word_places
from tidemark.session import scratch_path

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
SUPPORT = 0.75
STEPS = 3
LEAST_ROWS = 100
# The transformed statistics, and what counts as one draw of each: so many words or lines.
# Characters of a word go together, and a repeat covers two windows at least.
DRAWS = {
    "word_length": ("n_words", 1), "symbols": ("n_words", 1), "dup_lines": ("n_lines", 1),
    "repeats": ("n_words", 2 * WINDOW), "capitals": ("n_words", 1), "marks": ("n_words", 1),
}
# The share of documents, were they spread normally, that stays.
CONFIDENCE = 0.999
ACCURACY = 2000
# Estimates that are sent to all tasks: some 600 bytes each, 30 MB at most.
BROADCAST_GROUPS = 50_000
SALTS = 64

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_MARKS = np.zeros(256, dtype=bool)
_MARKS[list(b"!?;:=~^_@+/\\\"()[]{}")] = True
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks")


def text_statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every text."""
    texts = len(offsets) - 1
    starts, lengths, owner = word_places(data, offsets)
    counts = np.bincount(owner, minlength=texts)
    in_word = np.zeros(len(data) + 1, dtype=np.int8)
    in_word[starts] += 1
    np.subtract.at(in_word, starts + lengths, 1)
    in_word = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)
    out = {
        "n_words": counts,
        "word_chars": per_text(in_word & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": per_text(_SYMBOLS[data], offsets),
        "n_capitals": per_text((data >= ord("A")) & (data <= ord("Z")), offsets),
        "n_marks": per_text(_MARKS[data], offsets),
    }
    out["n_lines"], out["n_dup_lines"] = _lines(data, offsets, in_word)
    first = window_places(counts, WINDOW)
    repeated = np.zeros(texts, dtype=np.int64)
    if len(first):
        keys = mix(window_hashes(slice_hashes(data, starts, lengths), first, WINDOW) ^ mix(owner[first].astype(np.uint64)))
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(first), dtype=bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        cover = np.zeros(len(starts) + 1, dtype=np.int64)
        cover[first[twice]] += 1
        cover[first[twice] + WINDOW] -= 1
        repeated = np.bincount(owner[np.cumsum(cover[:-1]) > 0], minlength=texts)
    return out | {"n_repeat_words": repeated}


def _lines(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word per text, and those equal to an earlier one."""
    texts = len(offsets) - 1
    begins = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 0x0A) + 1]))
    begins = begins[begins < len(data)]
    ends = np.append(begins[1:], len(data))
    ends = ends - ((ends > begins) & (data[np.maximum(ends - 1, 0)] == 0x0A) if len(data) else 0)
    sums = np.concatenate([[0], np.cumsum(in_word)])
    filled = sums[ends] > sums[begins]
    begins, ends = begins[filled], ends[filled]
    owner = np.searchsorted(offsets, begins, side="right") - 1
    lines = np.bincount(owner, minlength=texts)
    keys = mix(slice_hashes(data, begins, ends - begins) ^ mix(owner.astype(np.uint64)))
    _, one = np.unique(keys, return_index=True)
    return lines, lines - np.bincount(owner[one], minlength=texts)


def statistics(docs: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """Counts, transformed vector ``x`` and its ``noise`` of every row, with its language and source.

    The square root of a rate of n draws has a variance of about 1 / 4n by chance.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in pieces(batch, size=LEAN):
                counts = text_statistics(data, offsets)
                arrays = [rows.column(0), rows.column(2), rows.column(3), rows.column(4), *(pa.array(counts[c].astype(np.int64)) for c in _COUNTS)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang", "source", "mark", *_COUNTS])

    mark = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("mark")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"), mark)
    kinds = f"lang {key_type(docs, lang)}, source {key_type(docs, source)}, mark bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS)
    counted = rows.mapInArrow(run, f"doc_id {key_type(docs, key)}, {kinds}")
    rate = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    vector = F.array(
        F.log(F.greatest(rate("word_chars", "n_words"), F.lit(1.0))),
        F.sqrt(rate("n_symbols", "word_chars")),
        F.sqrt(rate("n_dup_lines", "n_lines")),
        F.sqrt(rate("n_repeat_words", "n_words")),
        F.sqrt(rate("n_capitals", "word_chars")),
        F.sqrt(rate("n_marks", "word_chars")),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    noise = F.array(*[F.lit(size / 4) / F.greatest(F.col(count), F.lit(1)) for count, size in DRAWS.values()])
    return counted.withColumn("x", vector).withColumn("noise", noise).withColumn("base_failed", failed)


def _middle(value: Column) -> Column:
    return F.percentile_approx(value, 0.5, ACCURACY)


def in_units(rows: DataFrame) -> DataFrame:
    """Turns ``x`` into deviations from the median of all usable rows, in units of spread and noise."""
    size, usable = len(DRAWS), rows.where(~F.col("base_failed"))
    centre = [v or 0.0 for v in usable.agg(*[_middle(F.col("x")[i]) for i in range(size)]).first()]
    spread = [1.4826 * (v or 0.0) for v in usable.agg(*[_middle(F.abs(F.col("x")[i] - centre[i])) for i in range(size)]).first()]
    return rows.withColumn("x", F.array(*[(F.col("x")[i] - centre[i]) / F.sqrt(F.col("noise")[i] + spread[i] ** 2) for i in range(size)])).drop("noise")


def chi_square(probability: float, degrees: int) -> float:
    """Quantile of the chi-square law, by the cube-root normal approximation."""
    part = 2 / (9 * degrees)
    return degrees * (1 - part + NormalDist().inv_cdf(probability) * math.sqrt(part)) ** 3


def _with_groups(rows: DataFrame) -> DataFrame:
    """Adds ``g``, the group whose estimate judges a row, and ``feeds``, those it is estimated in.

    ``g`` is language and source, or if these have few usable rows the language, or all;
    null if the whole table has few. Language and all are estimated only where needed,
    from all their rows, those of large groups too.
    """
    rows = rows.withColumn("pair", F.to_json(F.struct("lang", "source"))).withColumn("own", F.concat(F.lit("lang "), F.to_json(F.struct("lang"))))
    pairs = rows.where(~F.col("base_failed")).groupBy("pair", "own").agg(F.count("*").alias("n"))
    small = F.col("n") < LEAST_ROWS
    by_lang = pairs.groupBy("own").agg(F.sum("n").alias("in_lang"), F.max(small).alias("asked"))
    total, fewest = by_lang.agg(F.coalesce(F.sum("in_lang"), F.lit(0)), F.min("in_lang")).first()
    rest = F.lit("all") if total >= LEAST_ROWS else F.lit(None).cast("string")
    wide = F.col("in_lang") >= LEAST_ROWS
    feeds = [F.when(~small, F.col("pair")), F.when(F.col("asked") & wide, F.col("own"))]
    if total >= LEAST_ROWS > fewest:
        feeds.append(F.lit("all"))
    names = pairs.join(by_lang, "own").select(
        "pair", F.when(~small, F.col("pair")).when(wide, F.col("own")).otherwise(rest).alias("g"), F.array_compact(F.array(*feeds)).alias("feeds")
    )
    return _join_groups(rows, names, "pair").drop("pair", "own")


def _join_groups(rows: DataFrame, groups: DataFrame, *key: str) -> DataFrame:
    """Left join of rows to the few rows of their group: sent to all tasks if few, else by salted key."""
    if groups.count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(groups), [*key], "left")
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "x"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, [*key, "salt"], "left").drop("salt")


def _distance(size: int) -> Column:
    """Squared Mahalanobis distance of ``x`` from the centre ``m`` under the inverse ``w``."""
    off = [F.col("x")[i] - F.col("m")[i] for i in range(size)]
    total = F.lit(0.0)
    for i in range(size):
        for j in range(i, size):
            total = total + (1.0 if i == j else 2.0) * F.col("w")[i * size + j] * off[i] * off[j]
    return total


def _moments(rows: DataFrame, size: int) -> DataFrame:
    """New centre, inverse covariance and logarithm of its determinant of each group and start."""
    off = [F.col("x")[i] - F.col("m")[i] for i in range(size)]
    sums = [F.avg(off[i]).alias(f"a{i}") for i in range(size)]
    sums += [F.avg(off[i] * off[j]).alias(f"a{i}_{j}") for i in range(size) for j in range(i, size)]
    kind = pa.schema([("g", pa.string()), ("start", pa.int32()), ("m", pa.list_(pa.float64())), ("w", pa.list_(pa.float64())), ("det", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                mean = np.array([r[f"a{i}"] for i in range(size)])
                second = np.array([[r[f"a{min(i, j)}_{max(i, j)}"] for j in range(size)] for i in range(size)])
                cover = second - np.outer(mean, mean)
                # The thousandth keeps it regular where statistics depend on each other.
                cover[np.diag_indices(size)] = 1.001 * np.maximum(np.diag(cover), 1)
                det = float(np.linalg.slogdet(cover)[1])
                out.append({"g": r["g"], "start": r["start"], "m": (np.array(r["m"]) + mean).tolist(), "w": np.linalg.inv(cover).ravel().tolist(), "det": det})
            yield pa.RecordBatch.from_pylist(out, schema=kind)

    return rows.groupBy("g", "start").agg(F.first("m").alias("m"), *sums).mapInArrow(run, "g string, start int, m array<double>, w array<double>, det double")


def _starts(used: DataFrame, spread: DataFrame, size: int) -> DataFrame:
    """Three first estimates of every group, around its medians ``m``.

    From median deviations ``s`` alone, from deviations bent by tanh, and from their
    directions, so that rows far away have little weight in each.
    """
    z = [(F.col("x")[i] - F.col("m")[i]) / F.col("s")[i] for i in range(size)]
    length = F.greatest(F.sqrt(sum((v * v for v in z[1:]), z[0] * z[0])), F.lit(1e-9))
    bent = F.array(*[F.col("m")[i] + F.col("s")[i] * F.tanh(z[i]) for i in range(size)])
    turned = F.array(*[F.col("m")[i] + F.col("s")[i] * z[i] * math.sqrt(size) / length for i in range(size)])
    both = F.array(F.struct(F.lit(1).alias("start"), bent.alias("x")), F.struct(F.lit(2).alias("start"), turned.alias("x")))
    moved = _join_groups(used, spread, "g").select("g", "m", F.explode(both).alias("v")).select("g", "m", "v.start", "v.x")
    diagonal = F.array(*[F.lit(1.0) / (F.col("s")[i] * F.col("s")[i]) if i == j else F.lit(0.0) for i in range(size) for j in range(size)])
    first = spread.select("g", F.lit(0).alias("start"), "m", diagonal.alias("w"), F.lit(None).cast("double").alias("det"))
    return first.unionByName(_moments(moved, size))


def estimates(rows: DataFrame) -> DataFrame:
    """Centre ``m`` and inverse covariance ``w`` of every group ``g`` of usable rows, whose ``x`` is in units."""
    spark, size = rows.sparkSession, len(DRAWS)
    home, made = scratch_path(spark, "mcd"), 0

    def kept(frame: DataFrame) -> DataFrame:
        nonlocal made
        made += 1
        frame.write.parquet(f"{home}/{made}")
        return spark.read.parquet(f"{home}/{made}")

    used = rows.where(~F.col("base_failed") & F.col("g").isNotNull()).select("doc_id", "g", "x")
    centre = kept(used.groupBy("g").agg(F.array(*[_middle(F.col("x")[i]) for i in range(size)]).alias("m")))
    off = [F.abs(F.col("x")[i] - F.col("m")[i]) for i in range(size)]
    spread = F.array(*[F.greatest(1.4826 * _middle(off[i]), F.lit(1.0)) for i in range(size)])
    now = kept(_starts(used, kept(_join_groups(used, centre, "g").groupBy("g").agg(F.first("m").alias("m"), spread.alias("s"))), size))
    for _ in range(STEPS):
        far = _join_groups(used, now.drop("det"), "g").withColumn("d", _distance(size))
        bound = kept(far.groupBy("g", "start").agg(F.percentile_approx("d", SUPPORT, ACCURACY).alias("bound")))
        now = kept(_moments(_join_groups(far, bound, "g", "start").where(F.col("d") <= F.col("bound")), size))
    least = now.groupBy("g").agg(F.min_by(F.struct("start", "m", "w"), F.struct("det", "start")).alias("e"))
    now = kept(least.select("g", "e.start", "e.m", "e.w"))
    far = _join_groups(used, now, "g").withColumn("d", _distance(size))
    # The half nearest to the centre is nearer than in a whole sample; widen to what is usual.
    wide = kept(far.groupBy("g").agg((F.percentile_approx("d", 0.5, ACCURACY) / chi_square(0.5, size)).alias("wide")))
    usual = F.col("d") <= chi_square(0.975, size) * F.greatest(F.lit(1.0), "wide")
    return kept(_moments(_join_groups(far, wide, "g").where(usual), size).select("g", "m", "w"))


def judge(docs: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", source: str = "source", confidence: float = CONFIDENCE) -> DataFrame:
    """Counts, base rule, distance and verdict ``kept`` of every row.

    ``mark`` is the CRC-32 of the text, which tells rows apart that share an id.

    A null text has no words and fails the base rule, as do texts of under 20 words or
    mostly repeated windows. Null language and source are a language and a source.
    Only if the whole table has under LEAST_ROWS usable documents nothing is judged by
    distance, which is null then. Repeated rows count as often as they occur. An empty table gives no row.
    """
    spark = docs.sparkSession
    home = scratch_path(spark, "quality")
    _statistics = statistics(docs, text, key, lang, source)
    _statistics.write.parquet(home)
    rows = _with_groups(in_units(spark.read.parquet(home)))
    fed = rows.where(~F.col("base_failed")).select("doc_id", "base_failed", "x", F.explode("feeds").alias("g"))
    judged = _join_groups(rows.drop("feeds"), estimates(fed), "g")
    distance = F.when(F.col("m").isNotNull(), F.sqrt(F.greatest(_distance(len(DRAWS)), F.lit(0.0))))
    return judged.withColumn("distance", distance).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= math.sqrt(chi_square(confidence, len(DRAWS))))).alias("kept"), "distance", "lang", "source", "mark",
    )
