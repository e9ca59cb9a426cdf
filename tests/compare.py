"""Compare registered queries with their SQL run by DuckDB on the same files.

    python -m tests.compare [--sf 0.01] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(normal(row[i]) for i in order) for row in rows),
        key=lambda row: [(value is None, str(type(value)), str(value)) for value in row],
    )


def compare(frame, connection, sql: str) -> tuple[int, str]:
    """Rows of the frame and a description of the first difference, if any."""
    mine_columns, mine = frame.columns, frame.collect()
    result = connection.sql(sql)
    if sorted(mine_columns) != sorted(result.columns):
        return len(mine), f"columns {sorted(mine_columns)} != {sorted(result.columns)}"
    kinds = dict(zip(result.columns, map(str, result.types), strict=True))
    same = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER",
            "double": "DOUBLE", "date": "DATE"}
    for name, kind in frame.dtypes:
        if same.get(kind) != kinds[name]:
            return len(mine), f"type of {name}: {kind} != {kinds[name]}"
    left, right = rows_of(mine_columns, mine), rows_of(result.columns, result.fetchall())
    if len(left) != len(right):
        return len(mine), f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right, strict=True):
        if a != b:
            return len(mine), f"{sorted(mine_columns)}: {a} != {b}"
    return len(mine), ""


def main(arguments: list[str]) -> int:
    from tidemark.catalog import all_queries
    from tidemark.session import local_session

    sf = "0.01"
    if arguments[:1] == ["--sf"]:
        sf, arguments = arguments[1], arguments[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    queries, oracles = all_queries()
    failed = 0
    for name in arguments or queries:
        began = time.time()
        try:
            frame = queries[name](spark, sf_dir)
            if name in oracles:
                count, problem = compare(frame, connection, oracles[name])
            else:
                count, problem = frame.count(), ""
        except Exception as error:  # a report line per query
            count, problem = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        mark = "FAIL" if problem else ("ok" if name in oracles else "rows")
        print(f"{mark:5}{name:26}{count:8} rows {time.time() - began:7.2f} s  {problem}", flush=True)
    return failed


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
