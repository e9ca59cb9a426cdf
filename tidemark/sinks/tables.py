"""Table versions on plain Parquet, published together by one pointer file.

A table is a set of slots (a batch date, or one slot for the whole table), and a
pointer names the folders of every slot. New folders are written first, checked, and
become visible when the next pointer is created; creating it fails when another
writer was faster. A failed load leaves folders nobody points at.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import PublishConflict
from tidemark.functions.times import DAY_SECONDS
from tidemark.schema import RAW, empty, relaxed, shaped, tables_of
from tidemark.sinks import files
from tidemark.spec import PRODUCTS, FeedSpec

WHOLE = "all"

# Store property with the number of hash buckets the dimension is kept in.
BUCKETS = "dimension-buckets"


# Tables whose files are partitioned by the day of their event time, so that a load opens
# the days it has events of and no others.
DAYS = ("fact",)
DAY = "event_day"
# Partition columns, named so that no column of a feed is called the same. Readers skip
# names with a leading underscore, but for partitions.
LOAD, PART, BUCKET = "_load", "_part", "_bucket"


def day_of(seconds: str, days: int = 1) -> Column:
    """Whole days since the epoch, in steps of ``days``: a number, so that any time has one."""
    return F.floor(F.col(seconds) / (days * DAY_SECONDS)) * days


# So many folders of one level in a slot are joined into one.
FOLDERS_PER_LEVEL = 16


def _level(folder: str) -> int:
    # table/level-id or table/_load=level-id, and perhaps a folder of a part
    level, mark, _ = folder.split("/")[1].removeprefix(f"{LOAD}=").partition("-")
    return int(level) if mark else 0


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Snapshot:
    version: int
    slots: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    properties: dict[str, str] = field(default_factory=dict)


class TableStore:
    """Tables of one feed; of products unless a spec and its raw schema are given."""

    def __init__(self, spark: SparkSession, root: str, spec: FeedSpec = PRODUCTS, raw: T.StructType = RAW):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = tables_of(spec, raw)
        self.spec = spec

    def snapshot(self) -> Snapshot:
        """The latest published state; version 0 before the first publish."""
        names = [n for n in files.names(self.spark, f"{self.root}/_pointers") if n.endswith(".json")]
        if not names:
            return Snapshot(0)
        content = files.read_json(self.spark, f"{self.root}/_pointers/{names[-1]}")
        return Snapshot(int(names[-1].split(".")[0]), content["slots"], content["properties"])

    def read(
        self, table: str, slots: Iterable[str] | None = None, snapshot: Snapshot | None = None, with_day: bool = False
    ) -> DataFrame:
        """A table, or some of its slots, as of a snapshot; empty when never written.

        ``with_day`` adds the partition column of a table that is partitioned by day.
        """
        known = (snapshot or self.snapshot()).slots.get(table, {})
        wanted = known if slots is None else [s for s in slots if s in known]
        return self.open(table, [path for slot in wanted for path in known[slot]], with_day)

    def open(self, table: str, paths: list[str], with_day: bool = False) -> DataFrame:
        schema = self.schemas[table]
        by = [T.StructField(LOAD, T.StringType()), T.StructField(PART, T.StringType()), T.StructField(DAY, T.LongType())] if table in DAYS else []
        whole = T.StructType([*schema.fields, *by])
        if paths:
            reader = self.spark.read.schema(relaxed(whole))
            reader = reader.option("basePath", f"{self.root}/{table}") if by else reader
            rows = reader.parquet(*[f"{self.root}/{p}" for p in paths])
        else:
            rows = empty(self.spark, whole)
        return rows.select(*schema.fieldNames(), *([DAY] if with_day and by else []))

    def write(self, table: str, df: DataFrame, level: int = 0) -> str:
        """Write rows to a new folder and return it; nothing is visible yet.

        No shuffle is added: scans pack small files together and adaptive execution
        sizes the output of joins, so files keep a sensible size over many versions. Only
        rows partitioned by day are brought together by day first. ``level`` is how often rows were rewritten to join folders.
        """
        if table in DAYS:
            return self._write_days(table, df, F.lit("all"), True, level)
        folder = f"{table}/{level}-{uuid.uuid4().hex}"
        shaped(df, self.schemas[table], {"loaded_at": F.current_timestamp()}).write.parquet(f"{self.root}/{folder}")
        return folder

    def _write_days(self, table: str, df: DataFrame, part: Column, gather: bool, level: int = 0) -> str:
        """Write rows below the table's folder by load, part and day, in one job."""
        rows = shaped(df, self.schemas[table], {"loaded_at": F.current_timestamp()})
        rows = rows.withColumns({PART: part, DAY: day_of(self.spec.target_time, self.spec.fact_days)})
        if gather:
            rows = rows.hint("rebalance", PART, DAY)
        folder = f"{table}/{LOAD}={level}-{uuid.uuid4().hex}"
        rows.write.partitionBy(PART, DAY).parquet(f"{self.root}/{folder}")
        return folder

    def joined(self, table: str, folders: list[str]) -> list[str]:
        """The folders of a slot, with the last ones of a level joined once there are many.

        Rows are rewritten once per level, so a slot that grows by a folder per
        micro-batch keeps fewer than FOLDERS_PER_LEVEL folders of each level.
        """
        folders = list(folders)
        while True:
            level = _level(folders[-1]) if folders else 0
            tail = 0
            while tail < len(folders) and _level(folders[-1 - tail]) == level:
                tail += 1
            if tail < FOLDERS_PER_LEVEL:
                return folders
            rows = self.open(table, folders[-tail:])
            rows = rows if table in DAYS else rows.hint("rebalance")
            folders[-tail:] = [self.write(table, rows, level + 1)]

    def expire(self, keep: int, unpublished: timedelta = timedelta(days=1)) -> int:
        """Delete all but the newest ``keep`` pointers, and folders that none of these names.

        Readers of older snapshots must be done. Folders that no pointer ever named, of
        failed loads or joined before they were published, go when they are older than
        ``unpublished``, longer than any load runs. Returns the number of folders deleted.
        Pointers go first, so a crash leaves folders without a pointer, not the reverse.
        """
        if keep < 1:
            raise ValueError("at least the newest pointer has to stay")
        names = [n for n in files.names(self.spark, f"{self.root}/_pointers") if n.endswith(".json")]
        old, kept = names[:-keep], names[-keep:]
        used, gone = self._folders(kept), self._folders(old)
        for name in old:
            files.delete(self.spark, f"{self.root}/_pointers/{name}")
        # A bucket folder lies in the folder of its write, of which others may be in use.
        held = {"/".join(path.split("/")[:2]) for path in used}
        oldest = 1000 * time.time() - unpublished / timedelta(milliseconds=1)
        written = [f"{t}/{n}" for t in self.schemas for n in files.names(self.spark, f"{self.root}/{t}")]
        stale = {f for f in written if f not in held and files.modified(self.spark, f"{self.root}/{f}") < oldest}
        lost = sorted((gone - used) | stale)
        for folder in lost:
            files.delete(self.spark, f"{self.root}/{folder}")
        return len(lost)

    def _folders(self, pointers: list[str]) -> set[str]:
        found = set()
        for name in pointers:
            content = files.read_json(self.spark, f"{self.root}/_pointers/{name}")
            found |= {path for slots in content["slots"].values() for paths in slots.values() for path in paths}
        return found

    def write_buckets(
        self, table: str, df: DataFrame, key: str, buckets: int, gather: bool
    ) -> dict[str, list[str]]:
        """Write rows by hash bucket of ``key``; returns the folder of each bucket.

        ``gather`` brings the rows of a bucket together first. Without it they stay
        where they are, which is right when they were read from bucket folders.
        """
        folder = f"{table}/{uuid.uuid4().hex}"
        rows = shaped(df, self.schemas[table]).withColumn(BUCKET, bucket_of(key, buckets))
        if gather and buckets > 1:
            rows = rows.hint("rebalance", BUCKET)
        rows.write.partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
        found = files.names(self.spark, f"{self.root}/{folder}")
        return {n.removeprefix(f"{BUCKET}="): [f"{folder}/{n}"] for n in found if n.startswith(f"{BUCKET}=")}

    def write_parts(self, table: str, df: DataFrame, label: str, gather: bool) -> dict[str, list[str]]:
        """Write rows by the value of column ``label`` in one job; returns the folder of each value.

        The column stays in the data. ``gather`` brings the rows of a value together, in
        as many partitions as their size asks for.
        """
        part = F.col(label).cast("string")
        if table in DAYS:
            folder = self._write_days(table, df, part, gather)
        else:
            folder = f"{table}/0-{uuid.uuid4().hex}"
            rows = shaped(df, self.schemas[table], {"loaded_at": F.current_timestamp()}).withColumn(PART, part)
            rows = rows.hint("rebalance", PART) if gather else rows
            rows.write.partitionBy(PART).parquet(f"{self.root}/{folder}")
        found = files.names(self.spark, f"{self.root}/{folder}")
        return {n.removeprefix(f"{PART}="): [f"{folder}/{n}"] for n in found if n.startswith(f"{PART}=")}

    def publish(
        self,
        base: Snapshot,
        slots: dict[str, dict[str, list[str]]],
        properties: dict[str, str] | None = None,
    ) -> Snapshot:
        """Make new folders visible, all or none. ``slots`` replaces those it names.

        When another writer published in between but left the named slots alone, the
        change is put on top of theirs; otherwise the publish fails. The same goes for
        the properties it sets, such as the highest key handed out.
        """
        current = base
        while True:
            merged = {table: dict(known) for table, known in current.slots.items()}
            for table, changed in slots.items():
                merged.setdefault(table, {}).update(changed)
            after = Snapshot(current.version + 1, merged, {**current.properties, **(properties or {})})
            location = f"{self.root}/_pointers/{after.version:012d}.json"
            content = {"slots": after.slots, "properties": after.properties}
            if files.create_json(self.spark, location, content):
                return after
            current = self.snapshot()
            for name in properties or {}:
                if current.properties.get(name) != base.properties.get(name):
                    raise PublishConflict(f"{name} was changed by another writer")
            for table, changed in slots.items():
                for slot in changed:
                    if current.slots.get(table, {}).get(slot) != base.slots.get(table, {}).get(slot):
                        raise PublishConflict(f"{table}/{slot} was published by another writer")

    def bootstrap(self, dimension_buckets: int = 1) -> Snapshot:
        """Publish empty tables unless there is a state already.

        A load rewrites only the dimension buckets its keys fall into, so a dimension
        much larger than a batch should have many.
        """
        base = self.snapshot()
        if base.version:
            return base
        return self.publish(
            base, {table: {} for table in self.schemas}, {BUCKETS: str(dimension_buckets)}
        )
