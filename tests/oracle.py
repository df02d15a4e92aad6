"""Compare a registered query with its SQL on the same Parquet files."""

from __future__ import annotations

import glob
import math
import os
from decimal import Decimal

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value if value is None or isinstance(value, str) else repr(value)


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def from_spark(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def from_duck(con, sql: str):
    cur = con.execute(sql)
    return canonical([d[0] for d in cur.description], cur.fetchall())


def difference(got, wanted) -> str | None:
    """A description of the first difference, or None."""
    if got[0] != wanted[0]:
        return f"columns {got[0]} != {wanted[0]}"
    if len(got[1]) != len(wanted[1]):
        extra = [r for r in got[1] if r not in set(wanted[1])][:3]
        lacking = [r for r in wanted[1] if r not in set(got[1])][:3]
        return f"{len(got[1])} rows != {len(wanted[1])}; extra {extra} lacking {lacking}"
    for a, b in zip(got[1], wanted[1]):
        if a != b:
            return f"{a} != {b}"
    return None
