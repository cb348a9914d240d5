"""Run a registered query on Spark and its SQL on DuckDB and compare all values."""

import math
from pathlib import Path

import duckdb


def duck(sf_dir):
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return float(v) + 0.0
    return v


def rows(columns, data):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in at) for r in data]
    return sorted(columns), sorted(out, key=lambda r: tuple((v is None, str(type(v) is str), v if v is not None else 0) for v in r))


def differences(df, con, sql, show=3):
    left = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    right = rows([d[0] for d in cur.description], cur.fetchall())
    if left[0] != right[0]:
        return f"columns differ: {set(left[0]) ^ set(right[0])}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} rows, expected {len(right[1])}"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if not bad:
        return ""
    cells = [(c, x, y) for a, b in bad[:show] for c, x, y in zip(left[0], a, b) if x != y]
    return f"{len(bad)} of {len(left[1])} rows differ, e.g. {cells[:8]}"
