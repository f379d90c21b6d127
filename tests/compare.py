"""Runs queries against their SQL twins: ``python -m tests.compare [-s SF_DIR] [name ...]``."""

from __future__ import annotations

import argparse
import math
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return connection


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value + 0.0, 9)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = [tuple(normal(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(keyed, key=lambda row: tuple((v is None, str(type(v)), v) for v in row))


def difference(spark, connection, sf: str, run, sql: str) -> str | None:
    """What differs between the two results, or None."""
    frame = run(spark, sf)
    got_columns, got = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    want_columns, want = rows_of(names, cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        only = [r for r in got if r not in set(want)][:2], [r for r in want if r not in set(got)][:2]
        return f"{len(got)} rows != {len(want)} rows; {str(only)[:400]}"
    wrong = [(a, b) for a, b in zip(got, want) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return f"{len(wrong)} of {len(got)} rows differ: {str(wrong[0])[:400]}" if wrong else None


def main() -> None:
    import __spark_entry__ as entry
    from reviewlens.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("-s", "--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, connection = local_session(), connect(args.sf)
    sql, queries = entry.oracle_sql(), entry.queries()
    for name in args.names or queries:
        start = time.time()
        try:
            if name in sql:
                problem = difference(spark, connection, args.sf, queries[name], sql[name])
                result = "same" if problem is None else f"DIFFERENT {problem}"
            else:
                rows = queries[name](spark, args.sf).collect()
                result = f"rows only: {len(rows)}, {str(rows[:2])[:250]}"
        except Exception as error:  # noqa: BLE001
            result = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{time.time() - start:6.1f}s {name}: {result}", flush=True)


if __name__ == "__main__":
    main()
