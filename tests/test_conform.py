from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark.errors import SchemaError
from tidemark.operators import conform
from tidemark.schema import RAW, STAGING, shaped

GOOD = {
    "code": "12345",
    "product_name": "Test Juice",
    "brands": "Test Brand",
    "nutrition_grades": "b",
    "categories_tags_en": ["Beverages", "Juices"],
    "last_modified_t": 1700000000,
}


def records(spark, *values):
    frame = spark.createDataFrame(
        [(i, v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)], "id int, text string"
    )
    return frame.select("id", F.parse_json("text").alias("record"))


def one(spark, value):
    return conform.conform_records(records(spark, value), "record", RAW).first()


def test_good_record_keeps_every_value(spark):
    row = one(spark, GOOD)
    assert {name: row[name] for name in GOOD} == GOOD
    assert row.violations == []


@pytest.mark.parametrize(
    ("change", "field", "value"),
    [
        ({"last_modified_t": 5.5}, "last_modified_t", 5),
        ({"last_modified_t": None}, "last_modified_t", None),
        ({"categories_tags_en": ["a", None]}, "categories_tags_en", ["a", None]),
        ({"categories_tags_en": []}, "categories_tags_en", []),
        ({"code": ""}, "code", ""),
        ({"code": None}, "code", None),
        ({"unknown": {"x": 1}}, "code", "12345"),
    ],
)
def test_accepted_oddities(spark, change, field, value):
    row = one(spark, {**GOOD, **change})
    assert row[field] == value
    assert row.violations == []


@pytest.mark.parametrize(
    "change",
    [
        {"code": 5},
        {"last_modified_t": "7"},
        {"last_modified_t": True},
        {"last_modified_t": 1e30},
        {"categories_tags_en": "abc"},
        {"categories_tags_en": [1]},
        {"product_name": ["x"]},
    ],
)
def test_violations_are_named_and_raised(spark, change):
    row = one(spark, {**GOOD, **change})
    assert row.violations == list(change)
    frame = conform.conform_records(records(spark, GOOD, {**GOOD, **change}), "record", RAW)
    with pytest.raises(SchemaError, match="1 records do not fit"):
        conform.require_conformed(frame)


def test_missing_fields_become_null(spark):
    row = one(spark, {"code": "1"})
    assert row.product_name is None and row.violations == []
    good = conform.require_conformed(conform.conform_records(records(spark, GOOD), "record", RAW))
    assert good.drop("id").columns == RAW.fieldNames()


@pytest.mark.parametrize(
    ("text", "usable"),
    [("7", True), ("5.5", True), ("1e9", True), ('"7"', False), ("true", False), ("null", False), (None, False)],
)
def test_usable_time(spark, text, usable):
    body = "{}" if text is None else f'{{"t":{text}}}'
    assert records(spark, body).select(conform.is_usable_time("record", "t")).first()[0] is usable


def test_rejects_name_their_code(spark):
    frame = records(spark, {"code": "a", "t": "7"}, {"code": "b", "t": 7}, {"code": "c"})
    report = conform.reject_report(frame, "record", "code", "t")
    assert sorted((r.code, r.reason) for r in report.collect()) == [("a", "string"), ("c", "missing")]


def test_tabular_input(spark):
    frame = spark.createDataFrame([("1", 7, "x")], "code string, last_modified_t int, other string")
    got = conform.conform_table(frame, RAW)
    assert got.columns == RAW.fieldNames()
    assert got.first().last_modified_t == 7
    bad = spark.createDataFrame([("1", "seven")], "code string, last_modified_t string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform.conform_table(bad, RAW).collect()


def test_empty_input_is_an_error(spark):
    with pytest.raises(SchemaError, match="No records"):
        conform.require_rows(spark.createDataFrame([], RAW))


def test_defaults_fill_missing_columns(spark):
    frame = spark.createDataFrame([("1",)], "code string")
    row = shaped(frame, STAGING, {"raw_object_key": F.lit("k")}).first()
    assert row.raw_object_key == "k" and row.brands is None
