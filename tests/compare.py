"""Run a registered query and its SQL twin, and say how they differ.

``python tests/compare.py <folder> [name ...]`` compares all or the named queries on a data folder.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
conversations""".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


_SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
              "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def differences(df, connection, sql: str) -> list[str]:
    found = connection.execute(sql)
    names = [column[0] for column in found.description]
    types = {column[0]: str(column[1]) for column in found.description}
    expected = _rows(found.fetchall(), names)
    actual = _rows(df.collect(), df.columns)
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} against {sorted(names)}")
    for field in df.schema:
        if field.name in types and _SAME_TYPE.get(field.dataType.simpleString()) != types[field.name]:
            problems.append(f"{field.name} is {field.dataType.simpleString()} against {types[field.name]}")
    if len(actual) != len(expected):
        problems.append(f"{len(actual)} rows against {len(expected)}")
    elif actual != expected:
        wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
        problems.append(f"{len(wrong)} of {len(actual)} rows differ, first {wrong[0]}")
    return problems


def main(folder: str, names: list[str]) -> int:
    from tillcast import registry, session

    spark = session.build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                  "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    queries, oracle = registry.queries(), registry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            problems = differences(df, connection, oracle[name])
            count = "ok"
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{name:32s} {time.time() - start:6.2f}s  {'; '.join(problems) or count}", flush=True)
    print(f"{failed} of {len(names or queries)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
