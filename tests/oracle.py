"""Compare registered queries with their SQL in DuckDB.

    python -m tests.oracle [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _kind(kind: pa.DataType) -> str:
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return "string"
    if pa.types.is_timestamp(kind):
        return "timestamp" + (kind.tz or "")
    if pa.types.is_decimal(kind):
        return f"decimal{kind.scale}"
    return str(kind)


def _rows(table: pa.Table, columns: list[str]) -> list[tuple]:
    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else value + 0.0
        return value

    values = zip(*[table.column(name).to_pylist() for name in columns])
    return sorted((tuple(plain(value) for value in row) for row in values), key=repr)


def compare(spark_result: pa.Table, expected: pa.Table) -> str | None:
    """None if equal, else the first difference found."""
    columns, wanted = sorted(spark_result.column_names), sorted(expected.column_names)
    if columns != wanted:
        return f"columns {columns} != {wanted}"
    kinds = {name: _kind(spark_result.schema.field(name).type) for name in columns}
    wanted_kinds = {name: _kind(expected.schema.field(name).type) for name in columns}
    if kinds != wanted_kinds:
        differing = {name: (kinds[name], wanted_kinds[name]) for name in columns if kinds[name] != wanted_kinds[name]}
        return f"types {differing}"
    if spark_result.num_rows != expected.num_rows:
        return f"rows {spark_result.num_rows} != {expected.num_rows}"
    for mine, theirs in zip(_rows(spark_result, columns), _rows(expected, columns)):
        if mine != theirs:
            return f"{columns}: {mine} != {theirs}"
    return None


def check(spark, name: str, sf_dir: str) -> tuple[str | None, int]:
    from lakeloom.queries import REGISTRY

    registered = REGISTRY[name]
    result = registered.run(spark, sf_dir).toArrow()
    if registered.sql is None:
        return (None if result.num_rows else "no rows"), result.num_rows
    expected = connect(sf_dir).execute(registered.sql).to_arrow_table()
    return compare(result, expected), result.num_rows


if __name__ == "__main__":
    from lakeloom.queries import REGISTRY
    from lakeloom.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session("oracle", "local[8]", {"spark.sql.shuffle.partitions": "8"})
    session.sparkContext.setLogLevel("ERROR")
    failures = 0
    for query in sys.argv[2:] or REGISTRY:
        started = time.perf_counter()
        try:
            problem, rows = check(session, query, folder)
        except Exception as error:
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {query:28s} rows={rows:<7d} "
              f"{time.perf_counter() - started:6.2f}s {problem or ''}", flush=True)
    print(f"{failures} failures")
