"""Compare registered queries with their SQL oracles.

    python tests/oracle_check.py [SF_DIR] [QUERY ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_point  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


SPARK_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when the query equals its oracle, else what differs."""
    frame = entry_point.queries()[name](spark, sf_dir)
    result = con.execute(entry_point.oracle_sql()[name])
    sql_types = {c[0]: str(c[1]) for c in result.description}
    spark_types = {c: SPARK_KINDS.get(kind, kind) for c, kind in frame.dtypes}
    if spark_types != sql_types:
        return f"schema {spark_types} != {sql_types}"
    expected = table_of(list(sql_types), result.fetchall())
    actual = table_of(frame.columns, [tuple(row) for row in frame.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    for left, right in zip(actual, expected):
        if left != right:
            return f"{left} != {right}"
    return None


if __name__ == "__main__":
    from conftest import build_session

    chosen_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session()
    connection = connect(chosen_dir)
    oracles = entry_point.oracle_sql()
    names = sys.argv[2:] or list(entry_point.queries())
    bad = 0
    for query_name in names:
        start = time.time()
        if query_name in oracles:
            problem = difference(session, connection, query_name, chosen_dir)
            verdict = "ok" if problem is None else f"DIFFERS {problem}"
            bad += problem is not None
        else:
            rows = entry_point.queries()[query_name](session, chosen_dir).count()
            verdict = f"rows only: {rows}"
        print(f"{query_name:26s} {time.time() - start:6.2f}s  {verdict}", flush=True)
    print("all match" if not bad else f"{bad} differ")
