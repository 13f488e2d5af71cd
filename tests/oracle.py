"""Run registered queries beside their SQL in DuckDB and compare all values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def sql_rows(sql: str, tables: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for path in sorted(Path(tables).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = connection.sql(sql)
    return result.columns, result.fetchall()


def _shown(value) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def in_order(columns: list[str], rows) -> list[tuple[str, ...]]:
    places = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(_shown(row[i]) for i in places) for row in rows)


def differences(frame, sql: str, tables: str) -> list[str]:
    """Empty if names and all rows are equal."""
    columns, rows = sql_rows(sql, tables)
    if sorted(columns) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} for {sorted(columns)}"]
    got = in_order(frame.columns, [tuple(r) for r in frame.collect()])
    wanted = in_order(columns, rows)
    if len(got) != len(wanted):
        return [f"{len(got)} rows for {len(wanted)}", f"{got[:1]} {wanted[:1]}"]
    return [f"{g} for {w}" for g, w in zip(got, wanted) if g != w][:3]
