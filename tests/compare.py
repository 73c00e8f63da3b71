"""Run a registered query in Spark and its SQL in DuckDB, and compare the rows exactly."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def oracle_connection(folder: str):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return f"{type(v).__name__}:{v}"


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=lambda t: tuple("" if x is None else x for x in t)
    )


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short description of the difference."""
    cur = con.execute(sql)
    o_names, o_rows = _rows([d[0] for d in cur.description], cur.fetchall())
    s_names, s_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    if s_names != o_names:
        return f"columns differ: only spark {set(s_names) - set(o_names)}, only sql {set(o_names) - set(s_names)}"
    if len(s_rows) != len(o_rows):
        return f"row counts differ: spark {len(s_rows)}, sql {len(o_rows)}"
    for a, b in zip(s_rows, o_rows):
        if a != b:
            diff = {n: (x, y) for n, x, y in zip(s_names, a, b) if x != y}
            same = {n: x for n, x, y in zip(s_names, a, b) if x == y}
            return f"values differ: {diff} at {dict(list(same.items())[:4])}"
    return None if s_rows else "no rows"
