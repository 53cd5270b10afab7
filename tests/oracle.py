"""Compare a Spark result with the SQL of the same query run by DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (2, "nan" if isinstance(value, float) and math.isnan(value) else repr(float(value)))
    return (3, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(_key(row[i]) for i in order) for row in rows])


def compare(con, sql: str, df) -> str | None:
    """None when equal, else what differs."""
    got = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    left, right = rows_of(df.columns, got), rows_of(names, want)
    if left != right:
        pair = next((a, b) for a, b in zip(left, right) if a != b)
        bad = [sorted(names)[i] for i, (x, y) in enumerate(zip(*pair)) if x != y]
        return f"values in {bad}: {[p for p in pair]}"[:800]
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    typed = {d[0]: str(d[1]) for d in result.description}
    wrong = {name: (kind, typed[name]) for name, kind in df.dtypes if kinds.get(kind) != typed[name]}
    return f"types {wrong}" if wrong else None
