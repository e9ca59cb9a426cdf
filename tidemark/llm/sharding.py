"""Sharding by fixed virtual slots and a versioned map from slots to shards.

A record's key hashes to one of thousands of virtual slots, for good. Bytes are summed per
slot, and a map says which shard holds which slot. Version 1 deals slots out in turn; a
rebalance moves single slots from the fullest shard to the emptiest and is the next
version, so a rebalance moves little data and never rehashes a record. A slot with far
more than its share (a key that occurs very often) is split into parts that the map holds
one by one. The map has at most as many rows as there are slots and parts, whatever the
number of records; only it is handled on the driver.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

VIRTUAL_SLOTS = 8192
PARTS = 64
# A slot with more than this share of all bytes or rows is split.
HEAVY_SHARE = 1 / 1024

Unit = tuple[int, int]


@dataclass(frozen=True)
class SlotMap:
    """Shard of every unit (virtual slot, part), with the bytes and rows it was made for."""

    version: int
    shards: int
    shard_of: dict[Unit, int]
    sizes: dict[Unit, tuple[int, int]] = field(repr=False)

    def loads(self) -> list[int]:
        out = [0] * self.shards
        for unit, shard in self.shard_of.items():
            out[shard] += self.sizes[unit][0]
        return out


def first_map(sizes: dict[Unit, tuple[int, int]], shards: int) -> SlotMap:
    return SlotMap(1, shards, {u: (u[0] + u[1]) % shards for u in sizes}, sizes)


def rebalance(old: SlotMap) -> SlotMap:
    """The next version: units moved or exchanged between the fullest and the emptiest shard."""
    held: list[list[tuple[int, Unit]]] = [[] for _ in range(old.shards)]
    for unit, shard in sorted(old.shard_of.items()):
        insort(held[shard], (old.sizes[unit][0], unit))
    loads = [sum(size for size, _ in h) for h in held]
    for _ in range(4 * len(old.sizes) + 64):
        full, low = max(range(old.shards), key=loads.__getitem__), min(range(old.shards), key=loads.__getitem__)
        gap = loads[full] - loads[low]
        moved = _best_change(held[full], held[low], gap)
        if moved is None:
            break
        out, back = moved
        for item, source, target in ((out, full, low), (back, low, full)):
            if item is not None:
                held[source].remove(item)
                insort(held[target], item)
                loads[source] -= item[0]
                loads[target] += item[0]
    return SlotMap(old.version + 1, old.shards, {unit: s for s, h in enumerate(held) for _, unit in h}, old.sizes)


def _best_change(full: list, low: list, gap: int):
    """What leaves the full shard and what it takes back, so that the gap shrinks most."""
    best, choice = gap, None
    for back in [None, *low]:
        size = back[0] if back else 0
        at = bisect_left(full, (size + gap // 2, (-1, -1)))
        for out in full[max(at - 1, 0) : at + 1]:
            left = abs(gap - 2 * (out[0] - size))
            if left < best:
                best, choice = left, (out, back)
        if best <= gap // 8:
            break
    return choice


def grow(old: SlotMap) -> SlotMap:
    """The next version with one more shard, which alone takes units, the others only give."""
    shards, new = old.shards + 1, old.shards
    shard_of, loads = dict(old.shard_of), [*old.loads(), 0]
    target = sum(loads) // shards
    for unit in sorted(shard_of, key=lambda u: (-old.sizes[u][0], u)):
        size = old.sizes[unit][0]
        if loads[new] + size <= target and loads[shard_of[unit]] - size >= target - size // 2 and size:
            loads[shard_of[unit]] -= size
            loads[new] += size
            shard_of[unit] = new
    return SlotMap(old.version + 1, shards, shard_of, old.sizes)


def store(spark: SparkSession, slot_map: SlotMap, path: str) -> None:
    """Write one version of the map as a folder of its own; versions are never changed."""
    frame(spark, slot_map).coalesce(1).write.parquet(f"{path}/version={slot_map.version}")


def frame(spark: SparkSession, slot_map: SlotMap) -> DataFrame:
    """The map as rows, with how many records its shard has before each unit."""
    before, rows = [0] * slot_map.shards, []
    for unit, shard in sorted(slot_map.shard_of.items()):
        rows.append((*unit, shard, *slot_map.sizes[unit], before[shard]))
        before[shard] += slot_map.sizes[unit][1]
    return spark.createDataFrame(rows, "v_slot int, part int, shard int, bytes bigint, records bigint, before bigint")


def load(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/version={version}")


def shard(docs: DataFrame, shards: int = 16, text: str = "text", key: str = "doc_id", map_path: str | None = None) -> DataFrame:
    """Per record: size, checksum, virtual slot, shard and gapless place in the shard.

    Sizes of shards come out near equal. Size is the text's bytes plus one; a null text
    has none, and the checksum of an empty text. A null key has a slot like any other.
    Repeated records each take a place. An empty table gives no row. ``map_path`` is where
    the versions of the map are stored; by default a scratch folder.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    records = scratch_path(spark, "shard-records")
    docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(key)), F.lit(VIRTUAL_SLOTS)).cast("int").alias("v_slot"),
        F.monotonically_increasing_id().alias("arrival"),
    ).write.parquet(records)
    rows = spark.read.parquet(records)
    sums = [F.sum("size").alias("bytes"), F.count("*").alias("records")]
    slots = {r["v_slot"]: (r["bytes"], r["records"]) for r in rows.groupBy("v_slot").agg(*sums).collect()}
    total = [sum(s[i] for s in slots.values()) for i in (0, 1)]
    heavy = sorted(s for s, both in slots.items() if any(both[i] > max(HEAVY_SHARE * total[i], 1) for i in (0, 1)) and both[1] > 1)
    part = F.when(F.col("v_slot").isin(heavy), F.pmod("arrival", F.lit(PARTS))).otherwise(0).cast("int") if heavy else F.lit(0)
    rows = rows.withColumn("part", part)
    units = {(slot, 0): both for slot, both in slots.items()}
    if heavy:
        split = rows.where(F.col("v_slot").isin(heavy)).groupBy("v_slot", "part").agg(*sums).collect()
        units = {u: both for u, both in units.items() if u[0] not in set(heavy)}
        units |= {(r["v_slot"], r["part"]): (r["bytes"], r["records"]) for r in split}
    path = map_path or scratch_path(spark, "slot-map")
    first = first_map(units, shards)
    last = rebalance(first)
    store(spark, first, path)
    store(spark, last, path)
    # At most VIRTUAL_SLOTS and, for each of fewer than 2 / HEAVY_SHARE heavy slots, PARTS rows.
    held = F.broadcast(load(spark, path, last.version).select("v_slot", "part", "shard", "before"))
    within = Window.partitionBy("v_slot", "part").orderBy("doc_id", "arrival")
    return (
        rows.withColumn("within", F.row_number().over(within) - 1)
        .join(held, ["v_slot", "part"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("before") + F.col("within")).cast("bigint").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"), F.col("v_slot").alias("virtual_slot"), "part",
        )
    )
