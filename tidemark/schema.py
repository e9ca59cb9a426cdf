"""Table schemas and their empty first versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.spec import FeedSpec

_STRING, _LONG, _DATE = T.StringType(), T.LongType(), T.DateType()
_INSTANT, _BOOL = T.TimestampType(), T.BooleanType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType(
        [T.StructField(name, kind, required[0] if required else True)
         for name, kind, *required in fields]
    )


RAW = _struct(
    ("code", _STRING, False),
    ("product_name", _STRING),
    ("brands", _STRING),
    ("nutrition_grades", _STRING),
    ("categories_tags_en", T.ArrayType(_STRING, True)),
    ("last_modified_t", _LONG),
)
RAW_COLUMNS = RAW.fieldNames()

STAGING = T.StructType(
    [
        *RAW.fields,
        T.StructField("batch_date", _DATE, False),
        T.StructField("raw_object_key", _STRING, False),
        T.StructField("loaded_at", _INSTANT, False),
    ]
)

DIMENSION = _struct(
    ("product_key", _LONG, False),
    ("code", _STRING, False),
    ("product_name", _STRING),
    ("brands", _STRING),
    ("nutrition_grades", _STRING),
    ("categories_tags_en", T.ArrayType(_STRING, True)),
    ("source_last_modified_t", _LONG),
    ("created_at", _INSTANT, False),
    ("updated_at", _INSTANT, False),
)

FACT = _struct(
    ("product_update_key", _LONG, False),
    ("product_key", _LONG, False),
    ("source_last_modified_t", _LONG, False),
    ("batch_date", _DATE, False),
    ("loaded_at", _INSTANT, False),
)

WATERMARKS = _struct(
    ("source_name", _STRING, False),
    ("watermark_ts", _INSTANT, False),
    ("updated_at", _INSTANT, False),
    ("run_id", _STRING, False),
)

DQ_METRICS = _struct(
    ("source_name", _STRING, False),
    ("pipeline_layer", _STRING, False),
    ("batch_date", _DATE, False),
    ("metric_name", _STRING, False),
    ("metric_value", _LONG, False),
    ("passed", _BOOL, False),
    ("expected_value", _LONG),
    ("recorded_at", _INSTANT, False),
)

OBJECT = _struct(("object_key", _STRING), ("row_count", _LONG), ("size_bytes", _LONG))

MANIFEST = _struct(
    ("schema_version", T.IntegerType()),
    ("source", _STRING),
    ("logical_date", _DATE),
    ("run_id", _STRING),
    ("attempt_id", _STRING),
    ("started_at", _INSTANT),
    ("completed_at", _INSTANT),
    ("object_count", _LONG),
    ("row_count", _LONG),
    ("objects", T.ArrayType(OBJECT)),
)

MARKER = _struct(
    ("schema_version", T.IntegerType()),
    ("source", _STRING),
    ("logical_date", _DATE),
    ("run_id", _STRING),
    ("attempt_id", _STRING),
    ("manifest_key", _STRING),
    ("object_count", _LONG),
    ("row_count", _LONG),
    ("extract_start", _INSTANT),
    ("extract_end", _INSTANT),
    ("next_watermark", _INSTANT),
    ("committed_at", _INSTANT),
    ("reject_count", _LONG),
)

TABLES: dict[str, T.StructType] = {
    "staging": STAGING,
    "dimension": DIMENSION,
    "fact": FACT,
    "watermarks": WATERMARKS,
    "dq_metrics": DQ_METRICS,
}

# Columns that must be unique together, per table.
UNIQUE_KEYS: dict[str, tuple[str, ...]] = {
    "dimension": ("code",),
    "fact": ("product_key", "source_last_modified_t"),
    "watermarks": ("source_name",),
    "dq_metrics": ("source_name", "pipeline_layer", "batch_date", "metric_name"),
}


def tables_of(spec: FeedSpec, raw: T.StructType) -> dict[str, T.StructType]:
    """Table schemas of a feed, from the roles of its columns and their types."""
    fields = {f.name: f for f in raw.fields}
    key, time = fields[spec.key].dataType, fields[spec.event_time].dataType
    return {
        "staging": T.StructType([*raw.fields, *STAGING.fields[len(RAW.fields) :]]),
        "dimension": _struct(
            (spec.surrogate, _LONG, False), (spec.key, key, False), *[(n, fields[n].dataType) for n in spec.attributes],
            (spec.target_time, time), ("created_at", _INSTANT, False), ("updated_at", _INSTANT, False),
        ),
        "fact": _struct(
            (spec.fact_key, _LONG, False), (spec.surrogate, _LONG, False), (spec.target_time, time, False),
            ("batch_date", _DATE, False), ("loaded_at", _INSTANT, False),
        ),
        "watermarks": WATERMARKS,
        "dq_metrics": DQ_METRICS,
    }


def unique_keys(spec: FeedSpec, table: str) -> tuple[str, ...]:
    """Columns of a feed's table that must be unique together."""
    return {"dimension": (spec.key,), "fact": (spec.surrogate, spec.target_time)}.get(table) or UNIQUE_KEYS[table]


def required_columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema.fields if not field.nullable]


def relaxed(schema: T.StructType) -> T.StructType:
    """The same schema with every column nullable, as files really are."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], relaxed(schema))


def shaped(df: DataFrame, schema: T.StructType, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Columns of ``schema`` by name; a missing one takes its default or null."""
    defaults = defaults or {}
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else defaults.get(f.name, F.lit(None)))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )
