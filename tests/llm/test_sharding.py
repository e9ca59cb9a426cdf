from __future__ import annotations

import zlib
from collections import defaultdict

from tidemark.llm import sharding
from tidemark.session import scratch_path


def check(rows, shards: int, spread: int) -> None:
    loads, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    full = [loads[s] for s in range(shards)]
    assert max(full) - min(full) <= spread


def test_shards_have_near_equal_bytes(spark):
    texts = {i: ("é" * (i % 97) if i % 11 else None) for i in range(3000)}
    frame = spark.createDataFrame([(i, t, i, "s") for i, t in texts.items()], "doc_id bigint, text string, slot bigint, shard string").repartition(5)
    rows = sharding.shard(frame).collect()
    assert len(rows) == 3000
    check(rows, 16, 2)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))


def test_a_key_with_a_third_of_the_rows_is_split(spark):
    frame = spark.createDataFrame([(7 if i % 3 == 0 else i, "x" * 50) for i in range(3000)], "doc_id bigint, text string").repartition(4)
    rows = sharding.shard(frame, shards=4).collect()
    check(rows, 4, 60)
    assert len({r.part for r in rows if r.doc_id == 7}) > 10


def test_null_keys_empty_tables_and_repeated_rows(spark):
    frame = spark.createDataFrame([(None, None)] * 5 + [(1, "a")] * 3, "doc_id bigint, text string")
    rows = sharding.shard(frame, shards=2).collect()
    assert len(rows) == 8
    check(rows, 2, 2)
    assert sharding.shard(frame.limit(0)).count() == 0


def test_versions_of_the_map(spark):
    sizes = {(s, 0): (10 + s % 7, 1) for s in range(200)}
    first = sharding.first_map(sizes, 8)
    second = sharding.rebalance(first)
    assert (first.version, second.version) == (1, 2)
    assert max(second.loads()) - min(second.loads()) <= 2
    third = sharding.grow(second)
    moved = {u for u in sizes if third.shard_of[u] != second.shard_of[u]}
    assert third.shards == 9 and moved and all(third.shard_of[u] == 8 for u in moved)
    assert third.loads()[8] > 0.8 * sum(third.loads()) / 9
    path = scratch_path(spark, "map")
    for one in (first, second):
        sharding.store(spark, one, path)
    for one in (first, second):
        assert {(r.v_slot, r.part): r.shard for r in sharding.load(spark, path, one.version).collect()} == one.shard_of
