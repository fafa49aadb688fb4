"""Run every registered query beside its SQL in DuckDB and compare rows, types and values.

usage: python tools/check_oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import importlib.util
import os
import sys
import time
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

from tidemark.session import spark_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def load_entry():
    spec = importlib.util.spec_from_file_location("__spark_entry__", f"{ROOT}/__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def open_oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _value(value):
    return repr(value) if isinstance(value, float) else value


def compare(result, connection, sql: str) -> tuple[str, int]:
    """``("ok", rows)`` or a description of the first difference."""
    relation = connection.sql(sql)
    names = sorted(result.columns)
    if names != sorted(relation.columns):
        return f"columns {names} / {sorted(relation.columns)}", 0
    expected_types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    for field in result.schema:
        spark_type = field.dataType.simpleString()
        if TYPES.get(spark_type) != expected_types[field.name]:
            return f"type of {field.name}: {spark_type} / {expected_types[field.name]}", 0
    found = Counter(tuple(_value(r[n]) for n in names) for r in result.collect())
    at = [relation.columns.index(n) for n in names]
    expected = Counter(tuple(_value(r[i]) for i in at) for r in relation.fetchall())
    if found == expected:
        return "ok", sum(found.values())
    only_found, only_expected = found - expected, expected - found
    return (
        f"{sum(found.values())} / {sum(expected.values())} rows; only here "
        f"{list(only_found)[:3]}; only there {list(only_expected)[:3]}; columns {names}"
    ), 0


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    entry = load_entry()
    spark = spark_session(
        "check", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled=False,
        spark__driver__memory="8g", spark__ui__showConsoleProgress=False,
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = open_oracle(sf_dir)
    oracles, failed = entry.oracle_sql(), 0
    for name, function in entry.queries().items():
        if wanted and name not in wanted:
            continue
        begin = time.time()
        try:
            result = function(spark, sf_dir)
            if name in oracles:
                outcome, rows = compare(result, connection, oracles[name])
            else:
                outcome, rows = "ok (rows only)", result.count()
        except Exception as error:  # report and go on with the next query
            outcome, rows = f"error {type(error).__name__}: {str(error)[:600]}", 0
        failed += not outcome.startswith("ok")
        print(f"{name:32s} {time.time() - begin:6.1f}s {rows:8d} {outcome}", flush=True)
    print(f"failed: {failed}")
    return failed


if __name__ == "__main__":
    sys.exit(main())
