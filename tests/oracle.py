"""Comparison of a Spark result with DuckDB, values and basic types."""

from __future__ import annotations

from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: tuple((value is None, str(type(value)), repr(value)) for value in row),
    )


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, else what differs."""
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    actual = _rows(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows instead of {len(expected)}"
    for mine, theirs in zip(actual, expected):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{str(mine)[:600]}\ninstead of\n{str(theirs)[:600]}"
    return None
