"""Raw load from landed page documents.

The documents are parsed once: one pass checks their shape, tests and extracts every
record's fields and writes the result by range of pages. Page statistics, the stopping
page, the records of a window and the rejected ones all come from that table, whose
folders beyond the stopping page are not opened.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import SchemaError
from tidemark.functions.times import epoch_of
from tidemark.operators import conform, pages
from tidemark.operators.windows import in_window
from tidemark.plans.raw_load import Reader, Scan
from tidemark.schema import RAW
from tidemark.session import scratch_path
from tidemark.sources.pages import page_items
from tidemark.spec import FeedSpec

# Pages of one folder of the parsed table.
PAGES_PER_RANGE = 1000
_RANGE, _SECONDS = "page_range", "event_seconds"


def parse_pages(documents: DataFrame, spec: FeedSpec, schema: T.StructType = RAW) -> DataFrame:
    """Records of the pages with typed fields, written by range of pages.

    Columns: page_number, declared_count, ``problem`` of the page's shape, position,
    ``event_seconds`` of a usable event time (as it is, not cut), ``reason`` why it is
    unusable, the fields of ``schema`` and ``violations`` of their types. A page without
    records has one row without position. A page number that is missing counts as page 0.
    """
    listed = page_items(documents)
    kind = conform.json_type("record", spec.event_time)
    tested = listed.withColumn("_kind", kind).select(
        "*",
        F.when(conform.is_number(F.col("_kind")), F.try_variant_get("record", f"$.{spec.event_time}", "double")).alias(_SECONDS),
        F.when(
            F.col("position").isNotNull() & ~F.coalesce(conform.is_number(F.col("_kind")), F.lit(False)),
            F.coalesce(F.lower("_kind"), F.lit("missing")),
        ).alias("reason"),
        F.try_variant_get("record", f"$.{spec.key}", "string").alias("named"),
    ).drop("_kind")
    typed = conform.conform_records(tested, "record", schema)
    path = scratch_path(documents.sparkSession, "records")
    placed = typed.withColumn(_RANGE, F.floor(F.coalesce("page_number", F.lit(0)) / PAGES_PER_RANGE))
    # Rows of a range meet first, or every task would write a file for every range.
    placed.hint("rebalance", _RANGE).write.partitionBy(_RANGE).parquet(path)
    return documents.sparkSession.read.schema(placed.schema).parquet(path)


def page_statistics(parsed: DataFrame) -> DataFrame:
    """Per page: records returned, newest and oldest usable time, declared count, problem."""
    return parsed.groupBy("page_number").agg(
        F.max("declared_count").alias("declared_count"),
        F.count("position").alias("returned"),
        F.floor(F.max(_SECONDS)).cast("long").alias("newest_t"),
        F.floor(F.min(_SECONDS)).cast("long").alias("oldest_t"),
        F.min("problem").alias("problem"),
    )


def stop_of(parsed: DataFrame, spec: FeedSpec, start: datetime, max_pages: int | None):
    """Where the scan of parsed pages ends for a window starting at ``start``.

    A page document of the wrong shape is an error, wherever it stands.
    """
    stats = page_statistics(parsed)
    wrong = stats.agg(F.count("problem").alias("pages"), F.min("problem").alias("why")).first()
    if wrong.pages:
        raise SchemaError(f"{wrong.pages} page documents have the wrong shape, for example: {wrong.why}")
    seen = pages.running_seen(stats)
    return pages.stop_page(seen, F.lit(epoch_of(start)), max_pages).first()


def up_to(parsed: DataFrame, last_page: int) -> DataFrame:
    """Rows of the pages that a scan reads; folders of later pages are left out."""
    inside = F.coalesce("page_number", F.lit(0)) <= F.lit(last_page)
    return parsed.filter((F.col(_RANGE) <= F.lit(last_page // PAGES_PER_RANGE)) & inside)


def page_reader(
    documents: DataFrame, spec: FeedSpec, max_pages: int | None = None, schema: T.StructType = RAW
) -> Reader:
    """Reader of page documents (see ``sources.pages.read_pages``) for ``load_raw``.

    Pages from the stopping page on are left out. Records without a usable event time
    are handed over as rejects; those outside the window are skipped. Only records that
    would be landed can violate the schema. Load with ``page="page_number"``.
    """
    pages.require_page_cap(max_pages)

    def read(start: datetime, end: datetime) -> Scan:
        parsed = parse_pages(documents, spec, schema)
        stop = stop_of(parsed, spec, start, max_pages)
        kept = up_to(parsed, stop.last_page if stop.last_page is not None else -1)
        inside = kept.filter(in_window(_SECONDS, start, end)).select("page_number", *schema.fieldNames(), "violations")
        rejects = kept.filter(F.col("reason").isNotNull()).select("page_number", "position", F.col("named").alias(spec.key), "reason")
        return Scan(conform.require_conformed(inside), stop.reason != "page_cap", rejects)

    return read
