"""Compare Spark queries with their SQL counterparts in DuckDB.

Run as a script: ``python tests/compare.py <table directory> [query ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        if file.endswith(".parquet"):
            con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=_key)


def compare(result, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, otherwise what differs first."""
    relation = con.execute(sql)
    names = [c[0] for c in relation.description]
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} against {sorted(names)}"
    expected = rows_of(names, relation.fetchall())
    actual = rows_of(result.columns, result.collect())
    if len(expected) != len(actual):
        return f"{len(actual)} rows against {len(expected)}"
    for got, want in zip(actual, expected):
        if got != want:
            return f"got {got}\nwant {want}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from adlumen.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = oracle_connection(sf_dir), oracle_sql(), 0
    for name, build in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            difference = compare(build(spark, sf_dir), con, sqls[name]) if name in sqls else "no SQL"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += difference is not None
        print(f"{name:28} {time.time() - start:6.2f}s {'ok' if difference is None else difference}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
