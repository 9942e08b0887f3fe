"""Run registered queries and their DuckDB statements side by side: ``python -m checks.compare DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from .jobs import QUERIES, TABLES
from .oracles import oracle_sql


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return duck


def plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return repr(value)
    return repr(value) if not isinstance(value, (list, tuple)) else repr([plain(v) for v in value])


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, duck, sf_dir: str, name: str, sql: str) -> tuple[bool, str]:
    started = time.time()
    frame = QUERIES[name](spark, sf_dir)
    got = rows_of(frame.columns, frame.collect())
    spark_time = time.time() - started
    started = time.time()
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    times = f"spark {spark_time:.2f}s duckdb {time.time() - started:.2f}s"
    if sorted(columns) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if got == want:
        return True, f"{len(got)} rows, {times}"
    extra, missing = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return False, f"{len(got)} rows, expected {len(want)}; only spark {extra[:3]}; only sql {missing[:3]}"


def main() -> None:
    from redactory.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, duck = local_session(8), connect(sf_dir)
    failed = 0
    for name, sql in oracle_sql().items():
        if names and name not in names:
            continue
        try:
            good, note = compare(spark, duck, sf_dir, name, sql)
        except Exception as error:
            good, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        failed += not good
        print(f"{'ok  ' if good else 'FAIL'} {name:30s} {note[:900]}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
