"""Run identity and object keys as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The URL namespace of RFC 9562, and our own name prefix.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
RUN_NAME_PREFIX = "tidemark:"

# Folders with a leading underscore stay out of Spark's data listing, while the files
# inside them can be read when their folder is named.
MANIFEST_NAME = "_manifest.json"
MARKER_NAME = "_commit/success.json"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def uuid5_hex(name: Column) -> Column:
    """Version-5 UUID of a name in the URL namespace, as 32 hex digits."""
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(name, "UTF-8")))
    # The variant puts binary 10 in front of the 17th digit.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat(
        F.substring(digest, 1, 12),
        F.lit("5"),
        F.substring(digest, 14, 3),
        variant,
        F.substring(digest, 18, 15),
    )


def run_id(source: Column | str, logical_date: Column | str) -> Column:
    """The same source and date always give the same run."""
    return uuid5_hex(
        F.concat(F.lit(RUN_NAME_PREFIX), _col(source), F.lit(":"), _col(logical_date).cast("string"))
    )


def attempt_id() -> Column:
    """A new random id per row and evaluation; materialise before using it twice."""
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))


def run_prefix(source: Column | str, logical_date: Column | str, run: Column | str) -> Column:
    return F.concat_ws(
        "/",
        _col(source),
        F.concat(F.lit("extract_date="), _col(logical_date).cast("string")),
        F.concat(F.lit("run_id="), _col(run)),
    )


def attempt_prefix(
    source: Column | str, logical_date: Column | str, run: Column | str, attempt: Column | str
) -> Column:
    return F.concat_ws(
        "/", run_prefix(source, logical_date, run), F.concat(F.lit("attempt_id="), _col(attempt))
    )


def part_name(number: Column | str) -> Column:
    return F.format_string("part-%05d.parquet", _col(number))


def part_key(prefix: Column, number: Column | str) -> Column:
    return F.concat_ws("/", prefix, part_name(number))


def manifest_key(prefix: Column) -> Column:
    return F.concat_ws("/", prefix, F.lit(MANIFEST_NAME))


def marker_key(prefix: Column) -> Column:
    return F.concat_ws("/", prefix, F.lit(MARKER_NAME))


def flat_part_key(source: Column | str, extract_date: Column | str, number: Column | str) -> Column:
    """Key in the daily layout without run and attempt folders."""
    return F.concat_ws(
        "/",
        _col(source),
        F.concat(F.lit("extract_date="), _col(extract_date).cast("string")),
        part_name(number),
    )
