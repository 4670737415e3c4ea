"""Run registered queries in Spark and their SQL in DuckDB, and compare whole results.

    python -m tests.oracle /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

import __spark_entry__ as entry
from goldspine.session import build_session
from goldspine.suite.tables import NAMES


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return value
    return str(value)


def bag(rows, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def families(types) -> list[str]:
    table = {"VARCHAR": "string", "DOUBLE": "double", "BIGINT": "bigint", "INTEGER": "int", "BOOLEAN": "boolean"}
    return [table.get(str(t), str(t).lower()) for t in types]


def compare(spark, connection, sf: str, name: str) -> tuple[bool, str]:
    df = entry.queries()[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        if unwanted in plan:
            return False, f"plan holds {unwanted}"
    found = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return len(found) > 0, f"{len(found)} rows, no SQL"
    relation = connection.sql(sql)
    expected = relation.fetchall()
    if sorted(df.columns) != sorted(relation.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    mine = sorted(zip(df.columns, [t for _, t in df.dtypes]))
    theirs = sorted(zip(relation.columns, families(relation.types)))
    if mine != theirs:
        return False, f"types {set(mine) ^ set(theirs)}"
    left, right = bag(found, df.columns), bag(expected, relation.columns)
    if left != right:
        return False, f"rows {len(found)}/{len(expected)} only spark {list((left - right).items())[:2]} only sql {list((right - left).items())[:2]}"
    return True, f"{len(found)} rows"


def main() -> int:
    sf, wanted = sys.argv[1], sys.argv[2:]
    spark, connection = build_session("oracle", 8), connect(sf)
    bad = 0
    for name in wanted or entry.queries():
        start = time.time()
        try:
            ok, note = compare(spark, connection, sf, name)
        except Exception as error:
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.time() - start:6.2f}s {note}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
