from __future__ import annotations

import json
import uuid
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.errors import GateError, WatermarkError
from tidemark.functions import identity
from tidemark.operators import control, quality
from tidemark.plans.raw_load import run_id_of
from tidemark.schema import WATERMARKS
from tidemark.spec import FeedSpec

SPEC = FeedSpec("code", "t", ("v",))
DAY = date(2026, 8, 18)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def test_run_id_is_uuid5(spark):
    frame = spark.createDataFrame([("feed", DAY), ("quelle-ä", DAY)], "source string, logical_date date")
    for row in control.with_run_id(frame).collect():
        name = f"tidemark:{row.source}:{row.logical_date}"
        assert row.run_id == uuid.uuid5(uuid.NAMESPACE_URL, name).hex == run_id_of(row.source, DAY)


def test_object_keys(spark):
    row = spark.range(1).select(
        identity.flat_part_key(F.lit("src"), F.lit(DAY), F.lit(3)).alias("flat"),
        identity.part_key(identity.attempt_prefix(F.lit("src"), F.lit(DAY), F.lit("r"), F.lit("a")), F.lit(12)).alias("part"),
    ).first()
    assert row.flat == "src/extract_date=2026-08-18/part-00003.parquet"
    assert row.part == "src/extract_date=2026-08-18/run_id=r/attempt_id=a/part-00012.parquet"


def objects(spark, sizes):
    rows = [("src", DAY, "r", "a", i, f"part-{i:05d}", n, b) for i, (n, b) in enumerate(sizes)]
    return spark.createDataFrame(
        rows,
        "source string, logical_date date, run_id string, attempt_id string, part_number int, "
        "object_key string, row_count bigint, size_bytes bigint",
    )


def test_manifest_adds_up(spark):
    manifests = control.build_manifests(objects(spark, [(4, 1000), (2, 500)]))
    row = manifests.first()
    assert (row.object_count, row.row_count, len(row.objects)) == (2, 6, 2)
    control.require_reconciled(control.reconcile_manifests(manifests))
    text = manifests.select(control.manifest_json(F.lit(at("2026-08-18")), F.lit(at("2026-08-19")))).first()[0]
    assert list(json.loads(text)) == sorted(json.loads(text))
    assert json.loads(text)["started_at"] == "2026-08-18T00:00:00+00:00"


def test_manifest_mismatch(spark):
    manifests = control.build_manifests(objects(spark, [(4, 1000), (2, 500)])).withColumn("row_count", F.lit(7).cast("long"))
    with pytest.raises(GateError, match="Raw manifest row-count mismatch"):
        control.require_reconciled(control.reconcile_manifests(manifests))


def test_large_manifests_are_split(spark):
    manifests = control.build_manifests(objects(spark, [(1, 10)] * 2500))
    rows = manifests.collect()
    assert sorted(len(r.objects) for r in rows) == [500, 1000, 1000]
    assert {(r.object_count, r.row_count) for r in rows} == {(2500, 2500)}
    assert control.manifest_objects(manifests).count() == 2500
    control.require_reconciled(control.reconcile_manifests(manifests))


def test_first_committer_wins(spark):
    rows = [("r1", "b", at("2026-08-18")), ("r1", "a", at("2026-08-19")), ("r2", "b", at("2026-08-18")), ("r2", "a", at("2026-08-18"))]
    tried = spark.createDataFrame(rows, "run_id string, attempt_id string, committed_at timestamp")
    assert {r.run_id: r.attempt_id for r in control.winning_attempts(tried).collect()} == {"r1": "b", "r2": "a"}


OFFER = "source_name string, watermark_ts timestamp, run_id string"


@pytest.mark.parametrize(
    ("stored", "offered", "changed"),
    [(None, "2026-08-19", True), ("2026-08-19", "2026-08-20", True),
     ("2026-08-20", "2026-08-20", False), ("2026-08-21", "2026-08-20", False)],
)
def test_watermark_moves_forward_only(spark, stored, offered, changed):
    rows = [("s", at(stored), at("2026-08-01"), "run-001")] if stored else []
    table = spark.createDataFrame(rows + [("other", at("2026-08-05"), at("2026-08-01"), "run-000")], WATERMARKS)
    new = spark.createDataFrame([("s", at(offered), "run-002")], OFFER)
    result = control.advance_watermarks(table, new, at("2026-09-01"))
    rows = {r.source_name: r for r in result.collect()}
    assert rows["s"].changed is changed and rows["other"].changed is False and not rows["other"].offered
    assert rows["s"].run_id == ("run-002" if changed else "run-001")
    assert rows["s"].watermark_ts.astimezone(UTC) == at(offered if changed else stored)
    assert rows["other"].updated_at.astimezone(UTC) == at("2026-08-01")
    if changed:
        control.require_advanced(result)
    else:
        with pytest.raises(WatermarkError, match="was not advanced"):
            control.require_advanced(result)


def test_recovery_takes_the_highest_commit(spark):
    commits = spark.createDataFrame(
        [("s", "r1", at("2026-08-19")), ("s", "r2", at("2026-08-20")), ("n", "r3", at("2026-08-02"))],
        "source string, run_id string, next_watermark timestamp",
    )
    stored = spark.createDataFrame([("s", at("2026-08-18"), at("2026-08-18"), "r0")], WATERMARKS)
    got = control.recover_watermarks(stored, commits, at("2026-09-01"))
    assert sorted((r.source_name, r.run_id, r.changed) for r in got.collect()) == [("n", "r3", True), ("s", "r2", True)]


# --- gates -------------------------------------------------------------------------


def paged(spark, rows):
    return spark.createDataFrame(rows, "page_number int, code string")


def test_raw_gate_allows_repeats_across_pages(spark):
    frame = paged(spark, [(1, "a"), (1, "b"), (2, "a"), (2, "")])
    assert quality.enforce_raw(quality.raw_gate(frame, "code")) == 4
    assert quality.duplicate_keys(frame, "code", ["page_number"]).count() == 0


@pytest.mark.parametrize(
    ("rows", "message"),
    [([], "nothing was landed"), ([(1, "a"), (1, None)], "Found 1 records with null keys"),
     ([(1, "12345"), (1, "12345")], "Duplicate keys"), ([(1, None), (1, None), (1, "x"), (1, "x")], "Found 2 records")],
)
def test_raw_gate_failures(spark, rows, message):
    with pytest.raises(GateError, match=message):
        quality.enforce_raw(quality.raw_gate(paged(spark, rows), "code"))


def staged(spark, codes):
    return spark.createDataFrame([(DAY, c, 5, "v") for c in codes], "batch_date date, code string, t bigint, v string")


@pytest.mark.parametrize(
    ("codes", "expected", "message"),
    [(["a", "b"], 2, None), ([], 0, None), (["a"], 2, "1 rows stored, 2 in the manifest"),
     (["a", None], 2, "null keys: 1"), ([None], 2, "row-count mismatch")],
)
def test_staging_gate(spark, codes, expected, message):
    wanted = spark.createDataFrame([(DAY, expected)], "batch_date date, expected_rows bigint")
    metrics = quality.staging_gate(staged(spark, codes), wanted, "code", "src")
    if message is None:
        assert [r.metric_name for r in quality.enforce(metrics)] == ["null_code_count", "row_count"]
    else:
        with pytest.raises(GateError, match=message) as failure:
            quality.enforce(metrics)
        assert len(failure.value.metrics) == 2 and not all(m.passed for m in failure.value.metrics)


@pytest.mark.parametrize(
    ("dim", "facts", "message"),
    [(["a", "b"], ["a", "b"], None), (["a"], ["a"], "Mart dimension reconciliation failed: 1"),
     (["a", "b"], ["a"], "Mart fact reconciliation failed: 1")],
)
def test_mart_gate(spark, dim, facts, message):
    numbers = {"a": 1, "b": 2}
    dimension = spark.createDataFrame([(c, numbers[c]) for c in dim], "code string, product_key bigint")
    fact = spark.createDataFrame([(numbers[c], 5) for c in facts], "product_key bigint, source_t bigint")
    metrics = quality.mart_gate(staged(spark, ["a", "b"]), dimension, fact, SPEC, "src", hot_rows=1, small=False)
    if message is None:
        assert len(quality.enforce(metrics)) == 2
    else:
        with pytest.raises(GateError, match=message):
            quality.enforce(metrics)


def test_mart_counts_rows_not_keys(spark):
    rows = [(DAY, "a", 5)] * 40 + [(DAY, "x", 5)] * 30 + [(DAY, None, None)] * 20 + [(DAY, "a", None)] * 10 + [(DAY, "a", 6)]
    frame = spark.createDataFrame(rows, "batch_date date, code string, t bigint")
    dimension = spark.createDataFrame([("a", 1)], "code string, product_key bigint")
    facts = spark.createDataFrame([(1, 5)], "product_key bigint, source_t bigint")
    for limits in ((5, False), (10_000, False), (5, True)):
        row = quality.mart_counts(frame, dimension, facts, SPEC, *limits).first()
        assert (row.missing_dimension_count, row.missing_fact_count) == (50, 31)


def test_metric_upsert_replaces_by_key(spark):
    counts = spark.createDataFrame([(DAY, 5)], "batch_date date, row_count bigint")
    old = quality.metric_rows(counts, "src", "staging", {"row_count": F.lit(4)})
    new = quality.metric_rows(counts, "src", "staging", {"row_count": F.lit(5)})
    other = quality.metric_rows(counts, "src", "raw", {"row_count": F.lit(5)})
    rows = quality.upsert_metrics(old.unionByName(other), new).collect()
    assert sorted((r.pipeline_layer, r.passed) for r in rows) == [("raw", True), ("staging", True)]


def test_table_rules(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2)], "code string, n int")
    quality.enforce_table(frame, "t", ("code", "n"), ("code",))
    with pytest.raises(GateError, match="not unique"):
        quality.enforce_table(frame, "t", ("code",), ("code",))
    with pytest.raises(GateError, match="required column n"):
        quality.enforce_table(frame.withColumn("n", F.lit(None).cast("int")), "t", (), ("code", "n"))
