"""Side-by-side run of a registered query and its SQL."""

from __future__ import annotations

import glob
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(plain, value)) + "]"
    if isinstance(value, float) and value == 0:
        return "0.0"
    return str(value)


def as_rows(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in at], sorted(tuple(plain(r[i]) for i in at) for r in rows)


def compare(df, con, sql: str, may_be_empty: bool = False) -> str | None:
    """None when both sides agree, else what differs first."""
    mine = as_rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = as_rows([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} != {len(theirs[1])}"
    if not mine[1] and not may_be_empty:
        return "no rows"
    for a, b in zip(mine[1], theirs[1]):
        if a != b:
            cells = [(c, x, y) for c, x, y in zip(mine[0], a, b) if x != y]
            return f"cells {cells[:6]} in {a}"
    return None
