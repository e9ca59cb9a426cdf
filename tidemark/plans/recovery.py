"""Watermarks of all sources brought up to their commits, from one scan of the markers."""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import functions as F

from tidemark.operators import control
from tidemark.operators.ranking import materialise
from tidemark.schema import WATERMARKS
from tidemark.session import releases_scratch
from tidemark.sinks.tables import TableStore
from tidemark.sources.commits import scan_all_markers

# Names of damaged markers that are reported.
REPORTED = 1000


@dataclass(frozen=True)
class Recovery:
    """Sources whose watermark moved, with the new one, and markers that cannot be used."""

    advanced: int
    torn: list[str]
    torn_count: int


@releases_scratch
def recover_all(store: TableStore, raw_root: str) -> Recovery:
    """Finish the watermark update of every committed run of every source.

    All markers are read as one JSON table, and all sources are compared, written and
    published at once; no source is read again. A marker that is not JSON, or lacks its
    source, run or next watermark, moves nothing and is reported by name; the other
    markers of its source still count. Running it again changes nothing.
    """
    markers = materialise(scan_all_markers(store.spark, raw_root), "markers")
    damaged = markers.where("damaged")
    base = store.snapshot()
    stored = store.read("watermarks", snapshot=base)
    result = materialise(
        control.recover_watermarks(stored, markers.where("NOT damaged"), F.current_timestamp()), "watermarks"
    )
    moved = result.where("changed")
    advanced = moved.count()
    if advanced:
        # A slot per source, as single loads keep it.
        parts = store.write_parts("watermarks", moved.select(*WATERMARKS.fieldNames()), "source_name", gather=True)
        store.publish(base, {"watermarks": {unquote(name): folders for name, folders in parts.items()}})
    names = [row.file for row in damaged.select("file").orderBy("file").limit(REPORTED).collect()]
    return Recovery(advanced, names, damaged.count())
