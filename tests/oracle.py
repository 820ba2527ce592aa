"""Compares a query with its SQL over one folder of tables."""

from __future__ import annotations

from pathlib import Path

import duckdb

from compare import rows_of


def connection(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def check(spark, con, query, sql: str | None, sf: str) -> None:
    df = query(spark, sf)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows_of(columns, result.fetchall())
