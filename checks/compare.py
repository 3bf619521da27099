"""Runs registered queries against their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from codesieve.session import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with the driver's tables as views."""
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns by name and rows in a fixed order, every value as text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark, connection, name: str, sf_dir: str) -> tuple[bool, str]:
    """Whether both engines agree, and a line that says so."""
    start = time.time()
    frame = QUERIES[name](spark, sf_dir)
    ours = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    took = time.time() - start
    if name not in ORACLE:
        return True, f"rows only  {len(ours[1]):7d} rows {took:6.2f}s"
    start = time.time()
    cursor = connection.execute(ORACLE[name])
    theirs = canonical([d[0] for d in cursor.description], cursor.fetchall())
    duck = time.time() - start
    if ours == theirs:
        return True, f"equal      {len(ours[1]):7d} rows {took:6.2f}s (duckdb {duck:.2f}s)"
    only_ours = sorted(set(ours[1]) - set(theirs[1]))[:2]
    only_theirs = sorted(set(theirs[1]) - set(ours[1]))[:2]
    return False, f"DIFFERENT  {ours[0]} {len(ours[1])} / {theirs[0]} {len(theirs[1])}\n   {only_ours}\n   {only_theirs}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(sf_dir), []
    for name in names:
        try:
            ok, line = compare(spark, connection, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - a failing query must not hide the others
            ok, line = False, f"ERROR      {str(error)[:1500]}"
        print(f"{name:24s} {line}", flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
