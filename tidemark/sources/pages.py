"""Landed page documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.conform import is_number, page_shape, require_page_shape

# Fixed value: the page number in a file name such as page-00012.json.
PAGE_FILE_PATTERN = r"page-(\d+)"


def read_pages(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Page documents as ``page_number``, ``declared_count`` and VARIANT ``doc``.

    A document is a JSON object with ``products`` (list), ``count`` and ``page``. One
    text line holds one document, so pages can share files of a sensible size; with
    ``one_per_file`` every file is one document, and its name may give the page
    number. Malformed JSON gives a null ``doc``, which the shape check reports.
    """
    raw = spark.read.text(path, wholetext=one_per_file).select(
        F.try_parse_json("value").alias("doc"), F.col("_metadata.file_name").alias("file_name")
    )
    from_name = F.try_to_number(
        F.regexp_extract("file_name", PAGE_FILE_PATTERN, 1), F.lit("9999999999")
    ).cast("long")
    return raw.select(
        F.coalesce(F.try_variant_get("doc", "$.page", "bigint"), from_name).alias("page_number"),
        F.try_variant_get("doc", "$.count", "bigint").alias("declared_count"),
        "doc",
    )


def page_records(pages: DataFrame, items: str = "products") -> DataFrame:
    """One row per record: ``page_number``, 0-based ``position``, VARIANT ``record``.

    A page without the list counts as empty.
    """
    return pages.select(
        "page_number",
        F.posexplode(F.try_variant_get("doc", f"$.{items}", "array<variant>")).alias("position", "record"),
    )


def page_items(pages: DataFrame, items: str = "products") -> DataFrame:
    """Page columns with ``problem`` (see ``page_shape``), ``position`` and ``record``.

    Unlike ``page_records`` it keeps a row, without position, for a page without records.
    The shape is tested before the records are taken apart: next to them it would be
    tested, on the whole document, once per record.
    """
    listed = F.try_variant_get("doc", f"$.{items}", "array<variant>")
    tested = pages.select("page_number", "declared_count", page_shape("doc", items).alias("problem"), listed.alias("_items"))
    return tested.select(
        "page_number", "declared_count", "problem", F.posexplode_outer("_items").alias("position", "record")
    )


def page_times(pages: DataFrame, event_time: str, items: str = "products") -> DataFrame:
    """Per page: records returned, newest and oldest usable event time, declared count.

    A document is a whole page, so this needs no shuffle; an empty page has a row.
    """
    listed = F.try_variant_get("doc", f"$.{items}", "array<variant>")
    with_list = pages.select("page_number", "declared_count", listed.alias("_items"))
    usable = F.transform(
        "_items",
        lambda record: F.when(
            is_number(F.schema_of_variant(F.try_variant_get(record, f"$.{event_time}", "variant"))),
            F.try_variant_get(record, f"$.{event_time}", "bigint"),
        ),
    )
    return with_list.select("page_number", "declared_count", F.size("_items").alias("_n"), usable.alias("_times")).select(
        "page_number",
        "declared_count",
        F.greatest("_n", F.lit(0)).cast("long").alias("returned"),
        F.array_max("_times").alias("newest_t"),
        F.array_min("_times").alias("oldest_t"),
    )


def scan_pages(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Records of all pages, after checking the shape of every document."""
    return page_records(require_page_shape(read_pages(spark, path, one_per_file)))
