"""Compares registered queries with their expected SQL, row by row and exactly.

Run as a script: ``python tests/compare.py [folder] [query ...]``.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _rows(records, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(r[i]) for i in order) for r in records)


SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def differences(df, connection, sql: str) -> list[str]:
    """What differs between a DataFrame and the SQL's result; empty if nothing does."""
    found = []
    expected = connection.execute(sql)
    names = [c[0] for c in expected.description]
    types = {c[0]: str(c[1]) for c in expected.description}
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(set(df.columns) ^ set(names))}"]
    for name, kind in df.dtypes:
        if SAME_TYPE.get(kind) != types[name]:
            found.append(f"type of {name}: {kind}, expected {types[name]}")
    want = _rows(expected.fetchall(), names)
    have = _rows([tuple(r) for r in df.collect()], df.columns)
    if want != have:
        found.append(f"rows: {sum(have.values())}, expected {sum(want.values())}")
        found.append(f"  columns {sorted(names)}")
        found += [f"  only here: {r}" for r in list((have - want))[:3]]
        found += [f"  only expected: {r}" for r in list((want - have))[:3]]
    return found


def main() -> int:
    import __spark_entry__ as entry
    from roadlens import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = get_session(spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g",
                        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    queries, expected, connection = entry.queries(), entry.oracle_sql(), connect(sf_dir)
    failed = 0
    for name, query in queries.items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            found = differences(query(spark, sf_dir), connection, expected[name]) if name in expected else ["no SQL"]
        except Exception as e:  # noqa: BLE001 - reported, the others still run
            found = [f"{type(e).__name__}: {str(e)[:1500]}"]
        failed += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - start:.2f}s", flush=True)
        for line in found:
            print("    ", line, flush=True)
    print(f"{failed} differ; SQL without query: {sorted(set(expected) - set(queries))}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
