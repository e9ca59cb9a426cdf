from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark.errors import SchemaError
from tidemark.operators import pages
from tidemark.operators.conform import require_page_shape
from tidemark.session import scratch_path
from tidemark.sources.pages import page_records, read_pages, scan_pages

STATS = "page_number bigint, returned bigint, newest_t bigint, total_seen bigint, declared_count bigint"


def stop(spark, rows, start=100, cap=None):
    row = pages.stop_page(spark.createDataFrame(rows, STATS), F.lit(start), cap).first()
    return row.stop_page, row.last_page, row.reason


@pytest.mark.parametrize(
    ("rows", "cap", "expected"),
    [
        ([(1, 50, 300, 50, 999), (2, 50, 99, 100, 999), (3, 50, 10, 150, 999)], None, (2, 1, "too_old")),
        ([(1, 50, 300, 50, 999), (2, 50, 100, 100, 999)], None, (None, 2, "exhausted")),
        ([(1, 50, 300, 50, 999), (2, 50, None, 100, 999), (3, 0, None, 100, 999)], None, (3, 2, "empty_page")),
        ([(1, 50, 300, 50, 60), (2, 10, 200, 60, 60), (3, 10, 150, 70, 60)], None, (2, 2, "all_seen")),
        ([(1, 50, 300, 50, None), (2, 50, 200, 100, None), (3, 5, 150, 105, None)], 2, (2, 2, "page_cap")),
        ([(1, 50, 300, 50, 100), (2, 50, 99, 100, 100)], 2, (2, 1, "too_old")),
    ],
)
def test_stop_page(spark, rows, cap, expected):
    assert stop(spark, rows, cap=cap) == expected


def test_page_cap_must_be_positive(spark):
    with pytest.raises(ValueError, match="max_pages must be at least 1"):
        stop(spark, [(1, 1, 1, 1, 1)], cap=0)


def test_bounds_of_an_unordered_page(spark):
    rows = [(1, 20), (1, 50), (1, 10), (2, None), (2, None)]
    got = pages.page_bounds(spark.createDataFrame(rows, "page_number bigint, t bigint"), "t")
    assert sorted(map(tuple, got.collect())) == [(1, 50, 10), (2, None, None)]


def test_running_seen_counts_every_page_once(spark):
    rows = [(s, p, (p * 7 + len(s)) % 50) for s in ("a", "bb") for p in range(1, 400)]
    frame = spark.createDataFrame(rows, "source string, page_number bigint, returned bigint")
    got = pages.running_seen(frame.repartition(7), ["source"]).collect()
    expected, total = [], {}
    for source, page, returned in rows:
        total[source] = total.get(source, 0) + returned
        expected.append((source, page, total[source]))
    assert sorted((r.source, r.page_number, r.total_seen) for r in got) == sorted(expected)


def test_pages_from_lines(spark):
    folder = scratch_path(spark, "lines")
    documents = [{"page": 1, "count": 3, "products": [{"code": "a"}, {"code": "b"}]}, {"page": 2, "count": 3}]
    spark.createDataFrame([(json.dumps(d),) for d in documents], "value string").write.text(folder)
    read = read_pages(spark, folder)
    assert sorted((r.page_number, r.declared_count) for r in read.collect()) == [(1, 3), (2, 3)]
    got = scan_pages(spark, folder).select("page_number", "position", F.try_variant_get("record", "$.code", "string"))
    assert sorted(map(tuple, got.collect())) == [(1, 0, "a"), (1, 1, "b")]


def test_page_number_from_file_name(spark, tmp_path):
    (tmp_path / "page-00012.json").write_text(json.dumps({"products": [{"code": "a"}]}, indent=2))
    read = read_pages(spark, str(tmp_path), one_per_file=True)
    assert [r.page_number for r in page_records(read).collect()] == [12]


@pytest.mark.parametrize("document", ["[1]", '{"products": 5}', "no json", "null"])
def test_bad_page_shape_stops_the_scan(spark, document):
    folder = scratch_path(spark, "bad")
    spark.createDataFrame([(document,), ('{"products": []}',)], "value string").write.text(folder)
    with pytest.raises(SchemaError, match="1 page documents have the wrong shape"):
        require_page_shape(read_pages(spark, folder))
