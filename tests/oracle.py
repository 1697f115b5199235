"""Run queries beside their SQL and compare rows.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def canonical(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def oracle_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    types = [str(d[1]) for d in cursor.description]
    return columns, types, canonical(columns, cursor.fetchall())


SAME_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN", "double": "DOUBLE"}


def compare(spark, con, name: str, query, sql: str, sf: str) -> list[str]:
    """What differs; empty when the two agree in columns, types and rows."""
    df = query(spark, sf)
    columns, types, expected = oracle_rows(con, sql)
    problems = []
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    declared = dict(zip(columns, types))
    for column, kind in df.dtypes:
        if SAME_TYPES.get(kind) != declared[column]:
            problems.append(f"type of {column}: {kind} != {declared[column]}")
    actual = canonical(df.columns, [tuple(row) for row in df.collect()])
    if len(actual) != len(expected):
        problems.append(f"{len(actual)} rows != {len(expected)}")
    if not expected:
        problems.append("no rows")
    differing = [(a, e) for a, e in zip(actual, expected) if a != e]
    if differing:
        problems.append(f"{len(differing)} rows differ, first:\n   spark  {differing[0][0]!r}\n   oracle {differing[0][1]!r}")
    return problems


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from leafmill.session import build_session

    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    wanted = args[1:]
    spark = build_session(spark__master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            if name in oracle_sql():
                problems = compare(spark, con, name, query, oracle_sql()[name], sf)
            else:
                problems = [] if query(spark, sf).count() else ["no rows"]
        except Exception as exc:  # report and go on
            problems = [f"{type(exc).__name__}: {str(exc)[:1500]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - began:.1f}s", *problems, sep="\n   " if problems else " ", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
