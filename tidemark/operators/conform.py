"""Records to the fixed schema: type tests first, then extraction.

``variant_get`` alone would turn a numeric code into text and a numeric text into a
number, so the stored JSON type decides before the value is taken.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import SchemaError
from tidemark.schema import shaped

# JSON types (as named by schema_of_variant) accepted for text, numbers and lists of
# text; decimals carry their precision in the name.
_TEXT = ("STRING",)
_NUMBER = ("BIGINT", "DOUBLE", "FLOAT")
_DECIMAL = "DECIMAL("
_TEXT_LIST = ("ARRAY<STRING>", "ARRAY<VOID>")


def _variant_at(record: str, name: str) -> Column:
    return F.try_variant_get(record, f"$.{name}", "variant")


def json_type(record: str, name: str) -> Column:
    """JSON type of a field; null when the field is missing."""
    return F.schema_of_variant(_variant_at(record, name))


def is_number(kind: Column) -> Column:
    """Whether a JSON type name is a number's."""
    return kind.isin(*_NUMBER) | kind.startswith(_DECIMAL)


def is_usable_time(record: str, name: str) -> Column:
    """Whether the event time is a JSON number. Text, booleans, null and absence are
    not usable.
    """
    return F.coalesce(is_number(json_type(record, name)), F.lit(False))


def _target(kind: T.DataType) -> tuple[Callable[[Column], Column], str]:
    """Test of the JSON type, and the type to extract, for a column type."""
    if isinstance(kind, T.StringType):
        return lambda found: found.isin(*_TEXT), "string"
    if isinstance(kind, T.LongType):
        return is_number, "bigint"
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return lambda found: found.isin(*_TEXT_LIST), "array<string>"
    raise SchemaError(f"no conversion from JSON to {kind.simpleString()}")


def conform_records(df: DataFrame, record: str, schema: T.StructType) -> DataFrame:
    """Typed columns of ``schema`` from a VARIANT record, next to the other columns.

    A missing field or JSON null gives null, fields outside the schema are dropped,
    a fractional number is cut to an integer. ``violations`` lists the fields whose
    type does not fit or whose value does not fit the type; it is empty for a good
    record. Null in a required column is left to the quality gate.
    """
    carried = [name for name in df.columns if name != record]
    names = schema.fieldNames()
    # One projection per step, so that each field and its type are looked up once.
    fields = df.select(*carried, *[_variant_at(record, n).alias(f"_f_{n}") for n in names])
    kinds = fields.select("*", *[F.schema_of_variant(f"_f_{n}").alias(f"_k_{n}") for n in names])
    typed, wrong = [], []
    for field in schema.fields:
        accepts, target = _target(field.dataType)
        found = F.col(f"_k_{field.name}")
        value = F.when(accepts(found), F.try_variant_get(f"_f_{field.name}", "$", target))
        typed.append(value.alias(field.name))
        present = found.isNotNull() & (found != "VOID")
        wrong.append(F.when(present & F.col(field.name).isNull(), F.lit(field.name)))
    values = kinds.select(*carried, *[f"_k_{n}" for n in names], *typed)
    return values.select(*carried, *names, F.array_compact(F.array(*wrong)).alias("violations"))


def require_conformed(df: DataFrame) -> DataFrame:
    """The good records without ``violations``; raises when any record is bad."""
    bad = F.size("violations") > 0
    row = df.agg(
        F.count_if(bad).alias("rows"), F.min(F.when(bad, F.concat_ws(", ", "violations"))).alias("fields")
    ).first()
    if row.rows:
        raise SchemaError(f"{row.rows} records do not fit the schema, for example in: {row.fields}")
    return df.drop("violations")


def conform_table(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Tabular input to ``schema`` by name; a value that cannot be cast is an error."""
    return shaped(df, schema)


_WIDER = {"bigint": {"int", "smallint", "tinyint"}, "int": {"smallint", "tinyint"}, "double": {"float"}}


def require_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The input, if its columns have the types of ``schema`` or narrower ones.

    No value is turned into another kind: a number in place of a text, or a text in
    place of a list, is an error before anything is read. A missing column is one only
    if the schema requires it.
    """
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for field in schema.fields:
        wanted, kind = field.dataType.simpleString(), found.get(field.name)
        if kind is None and not field.nullable:
            raise SchemaError(f"column {field.name} is missing")
        if kind not in (None, wanted, "void") and kind not in _WIDER.get(wanted, ()):
            raise SchemaError(f"column {field.name} has type {kind} instead of {wanted}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise SchemaError("No records to convert.")
    return df


def page_shape(doc: str, items: str = "products") -> Column:
    """What is wrong with a page document; null for a good one.

    It must be an object, and its list of records, when present, a list.
    """
    is_object = F.try_variant_get(doc, "$", "map<string,variant>").isNotNull()
    listed = F.try_variant_get(doc, f"$.{items}", "variant")
    is_list = F.try_variant_get(doc, f"$.{items}", "array<variant>").isNotNull()
    return (
        F.when(F.col(doc).isNull(), "not_json")
        .when(~is_object, "not_an_object")
        .when(listed.isNotNull() & ~is_list, "records_not_a_list")
    )


def require_page_shape(pages: DataFrame, doc: str = "doc", items: str = "products") -> DataFrame:
    problem = page_shape(doc, items)
    row = pages.agg(F.count_if(problem.isNotNull()).alias("pages"), F.min(problem).alias("why")).first()
    if row.pages:
        raise SchemaError(f"{row.pages} page documents have the wrong shape, for example: {row.why}")
    return pages


def split_usable(df: DataFrame, record: str, event_time: str) -> tuple[DataFrame, DataFrame]:
    """Records with a usable event time, and the rejected ones."""
    usable = is_usable_time(record, event_time)
    return df.filter(usable), df.filter(~usable)


def reject_report(df: DataFrame, record: str, key: str, event_time: str) -> DataFrame:
    """One row per rejected record: its key and why its event time is unusable."""
    found = json_type(record, event_time)
    _, rejected = split_usable(df, record, event_time)
    return rejected.withColumn(
        key, F.try_variant_get(record, f"$.{key}", "string")
    ).withColumn("reason", F.coalesce(F.lower(found), F.lit("missing"))).drop(record)
