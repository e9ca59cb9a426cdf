"""Tool calls of conversations, linked to their results, ordered, validated, serialised.

Calls and results meet by an equi-join on (conversation, call id). The step of a call is
one more than the largest step of the calls it comes after: calls after one other call
form chains, whose ends are found by pointer doubling, in as many rounds as the logarithm
of the longest chain; calls after several are resolved from the chains they join. No
conversation is gathered in one task. Arguments are checked against the schema of the
tool and every call is written as canonical JSON: keys in order, no blanks, numbers and
letters in their plain form. Numbers keep all their digits; halves of surrogate pairs that
stand alone, which UTF-8 lacks, stay escaped.
"""

from __future__ import annotations

import decimal
import json
import re
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path

_KINDS = {
    "string": str, "boolean": bool, "object": dict, "array": list, "null": type(None),
    "integer": int, "number": (int, float, Decimal),
}
# Arguments may be nested so deeply; well inside what every worker's stack holds.
DEEPEST = 100
# Integers of more digits are read as decimals, which have no limit of digits.
_INTEGER_DIGITS = 4000
_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.DOTALL)
_LONE = re.compile("[\ud800-\udfff]")


def canonical(value) -> str:
    """JSON text that is equal for equal values, and only for these; no number that JSON lacks."""
    if isinstance(value, dict):
        return "{" + ",".join([f"{canonical(k)}:{canonical(value[k])}" for k in sorted(value)]) + "}"
    if isinstance(value, list):
        return "[" + ",".join([canonical(v) for v in value]) + "]"
    if isinstance(value, (int, Decimal)) and not isinstance(value, bool):
        return _number(Decimal(value))
    text = json.dumps(value, ensure_ascii=False, allow_nan=False)
    return _escaped(text) if isinstance(value, str) else text


def _number(value: Decimal) -> str:
    sign, digits, exponent = value.as_tuple()
    text = "".join(map(str, digits)).lstrip("0")
    plain = text.rstrip("0")
    if not plain:
        return "0"
    exponent += len(text) - len(plain)
    lead = len(plain) - 1 + exponent
    if not -7 < lead < 21:
        plain = plain[0] + ("." + plain[1:] if plain[1:] else "") + f"e{lead}"
    elif exponent >= 0:
        plain += "0" * exponent
    elif lead >= 0:
        plain = plain[: lead + 1] + "." + plain[lead + 1 :]
    else:
        plain = "0." + "0" * (-lead - 1) + plain
    return "-" * sign + plain


def _escaped(text: str) -> str:
    return _LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def _integer(text: str) -> int | Decimal:
    return int(text) if len(text) <= _INTEGER_DIGITS else Decimal(text)


def _depth(text: str) -> int:
    """How deeply brackets outside of strings are nested."""
    deepest = at = 0
    for mark in re.findall(r"[\[{\]}]", _STRING.sub("", text)):
        at += 1 if mark in "[{" else -1
        deepest = max(deepest, at)
    return deepest


def problems(value, schema: dict, at: str = "$") -> list[str]:
    """How a value departs from a schema: type, enum, bounds, properties, items."""
    kinds = schema.get("type")
    if kinds is not None:
        # An integer of very many digits is held as a decimal without a fraction.
        whole = isinstance(value, Decimal) and value.as_tuple().exponent == 0
        fits = any(
            isinstance(value, _KINDS[k]) and not (isinstance(value, bool) and k in ("integer", "number"))
            or k == "integer" and whole
            for k in ([kinds] if isinstance(kinds, str) else kinds)
        )
        if not fits:
            return [f"{at}: not of type {kinds}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not an allowed value")
    if isinstance(value, (int, Decimal)) and not isinstance(value, bool):
        if "minimum" in schema and value < schema["minimum"]:
            out.append(f"{at}: below {schema['minimum']}")
        if "maximum" in schema and value > schema["maximum"]:
            out.append(f"{at}: above {schema['maximum']}")
    if isinstance(value, str) and len(value) > schema.get("maxLength", len(value)):
        out.append(f"{at}: longer than {schema['maxLength']}")
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        out.append(f"{at}: shorter than {schema['minLength']}")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{name}: missing" for name in schema.get("required", []) if name not in value]
        for name in sorted(value):
            if name in known:
                out += problems(value[name], known[name], f"{at}.{name}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{name}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            out += problems(item, schema["items"], f"{at}[{i}]")
    return out


def _no_constant(text: str):
    raise ValueError(f"{text} is no JSON number")


def _steps(nodes: DataFrame) -> DataFrame:
    """(conv, call, step, chained) of every call; step is null on and after a cycle.

    ``nodes`` has one row per call, with the distinct existing calls it comes after.
    """
    spark = nodes.sparkSession
    home = scratch_path(spark, "steps")
    # Pointer to the nearest earlier call that is after none or after several.
    nodes.select(
        "conv", "call", "after",
        F.when(F.size("after") == 1, F.col("after")[0]).otherwise(F.col("call")).alias("anchor"),
        (F.size("after") == 1).cast("bigint").alias("distance"),
        (F.size("after") != 1).alias("settled"),
    ).write.parquet(f"{home}/0")
    round_, at = 0, spark.read.parquet(f"{home}/0")
    count = at.count()
    while at.where(~F.col("settled")).limit(1).count() and (1 << round_) <= 2 * max(count, 1):
        there = at.select("conv", F.col("call").alias("anchor"), F.col("anchor").alias("a2"), F.col("distance").alias("d2"), F.col("settled").alias("s2"))
        jumped = at.where(~F.col("settled")).join(there, ["conv", "anchor"]).select(
            "conv", "call", "after", F.col("a2").alias("anchor"), (F.col("distance") + F.col("d2")).alias("distance"), F.col("s2").alias("settled")
        )
        round_ += 1
        at.where("settled").unionByName(jumped).write.parquet(f"{home}/{round_}")
        at = spark.read.parquet(f"{home}/{round_}")
    # Anchors: roots have step 0, joining calls wait until all calls before them are known.
    steps = at.where(F.col("settled") & (F.size("after") == 0)).select("conv", F.col("call").alias("anchor"), F.lit(0).cast("bigint").alias("base"))
    joining = at.where(F.size("after") > 1).select("conv", F.col("call").alias("joint"), F.explode("after").alias("call"))
    if joining.limit(1).count():
        waits = joining.join(at.where("settled").select("conv", "call", "anchor", "distance"), ["conv", "call"], "left")
        waits.write.parquet(f"{home}/waits")
        waits, known, turn = spark.read.parquet(f"{home}/waits"), -1, 0
        while True:
            steps.write.parquet(f"{home}/steps{turn}")
            steps = spark.read.parquet(f"{home}/steps{turn}")
            have, known, turn = known, steps.count(), turn + 1
            if have == known:
                break
            ready = (
                waits.join(steps, ["conv", "anchor"], "left")
                .groupBy("conv", "joint")
                .agg(F.max(F.col("base") + F.col("distance") + 1).alias("base"), F.count_if(F.col("base").isNull()).alias("open"))
                .where("open = 0").select("conv", F.col("joint").alias("anchor"), "base")
            )
            roots = spark.read.parquet(f"{home}/steps0")
            steps = roots.unionByName(ready)
    settled = F.when(F.col("settled"), F.col("base") + F.col("distance"))
    return at.join(steps, ["conv", "anchor"], "left").select("conv", "call", settled.alias("step"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call: step, status, problems, and the call with its result as JSON.

    ``calls``: conv, call, name, arguments (JSON text), after (ids of earlier calls);
    ``results``: conv, call, content. Ids are unique in a conversation: of calls that
    repeat an id the one with the least name and arguments stays, of results the one with
    the least content. Calls without conversation or id, and results without a call, are
    no rows. Unknown ids in ``after`` are a problem and otherwise ignored, as is a call
    after itself; a null list is empty. Arguments that are null or no JSON object, that are
    nested more than DEEPEST levels deep or hold a number beyond what decimals can hold
    (exponents of 18 digits), and tools without a schema, are problems; such arguments are
    kept as the text they came in. ``status``: ``cycle``, ``invalid``,
    ``unanswered``, ``ok``, the first that holds. Empty tables give no rows. Schemas are
    those of the tools on offer, whose number does not grow with the conversations.
    """
    spark = calls.sparkSession
    home = scratch_path(spark, "calls")
    of = lambda df: df.where(F.col("conv").isNotNull() & F.col("call").isNotNull())
    after = F.array_distinct(F.filter(F.coalesce("after", F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != F.col("call"))))
    struct = F.min(F.struct("name", "arguments", "after", "selfish")).alias("c")
    of(calls).select(
        "conv", "call", "name", "arguments", F.array_sort(after).alias("after"),
        F.coalesce(F.array_contains("after", F.col("call")), F.lit(False)).alias("selfish"),
    ).groupBy("conv", "call").agg(struct).select("conv", "call", "c.*").write.parquet(f"{home}/calls")
    one = spark.read.parquet(f"{home}/calls")
    answer = of(results).groupBy("conv", "call").agg(F.min("content").alias("content"), F.lit(True).alias("answered"))
    wanted = one.select("conv", "call", F.explode("after").alias("before"))
    exists = one.select("conv", F.col("call").alias("before"))
    real = wanted.join(exists, ["conv", "before"]).groupBy("conv", "call").agg(F.array_sort(F.collect_list("before")).alias("real"))
    linked = one.join(real, ["conv", "call"], "left").withColumn("real", F.coalesce("real", F.array().cast("array<string>")))
    steps = _steps(linked.select("conv", "call", F.col("real").alias("after")))
    rows = (
        linked.join(steps, ["conv", "call"]).join(answer.hint("shuffle_hash"), ["conv", "call"], "left")
        .withColumn("unknown", F.array_except("after", "real"))
        .select("conv", "call", "name", "arguments", "step", "content", F.coalesce("answered", F.lit(False)).alias("answered"), "real", "unknown", "selfish")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_row(r, schemas) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), batch.column(4), *(pa.array([o[i] for o in out], kind) for i, kind in enumerate((pa.string(), pa.list_(pa.string()), pa.string())))],
                ["conv_id", "call_id", "name", "step", "status", "problems", "record"],
            )

    kind = rows.schema["conv"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv_id {kind}, call_id string, name string, step bigint, status string, problems array<string>, record string")


def _row(row: dict, schemas: dict[str, dict]) -> tuple[str, list[str], str]:
    found, arguments, text = [], None, row["arguments"] or ""
    try:
        if _depth(text) > DEEPEST:
            found.append(f"arguments: more than {DEEPEST} levels")
        else:
            arguments = json.loads(text, parse_float=Decimal, parse_int=_integer, parse_constant=_no_constant)
            if not isinstance(arguments, dict):
                found.append("arguments: no object")
            elif row["name"] not in schemas:
                found.append("name: no such tool")
            else:
                found += map(_escaped, problems(arguments, schemas[row["name"]]))
    except ValueError:
        found.append("arguments: no JSON")
    except decimal.DecimalException:
        found.append("arguments: number out of range")
    found += [f"after: no call {name}" for name in row["unknown"]]
    if row["selfish"]:
        found.append("after: the call itself")
    cycle = row["step"] is None
    status = "cycle" if cycle else "invalid" if found else "ok" if row["answered"] else "unanswered"
    record = canonical({
        "after": row["real"], "arguments": arguments if isinstance(arguments, dict) else row["arguments"],
        "id": row["call"], "name": row["name"], "result": row["content"], "step": row["step"],
    })
    return status, found, record
