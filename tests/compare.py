"""Spark results against DuckDB on the same tables, as multisets of rows."""

from __future__ import annotations

import decimal
from collections import Counter
from pathlib import Path

import duckdb


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.isoformat() if hasattr(v, "isoformat") else v


def rows_of(df) -> tuple[list[str], Counter]:
    return df.columns, Counter(tuple(map(plain, r)) for r in df.collect())


def assert_same(df, sql: str, folder: str) -> None:
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    columns, a = rows_of(df)
    assert sorted(columns) == sorted(names)
    at = [names.index(c) for c in columns]
    b = Counter(tuple(plain(r[i]) for i in at) for r in got.fetchall())
    assert a == b, (list((a - b).items())[:3], list((b - a).items())[:3])
