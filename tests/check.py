"""Compare a query's rows with its SQL counterpart in DuckDB."""

from __future__ import annotations

from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def _value(value):
    return float(value) if isinstance(value, Decimal) else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, fn, sql: str, sf_dir: str) -> tuple[int, str | None]:
    """Row count, and the first difference or None."""
    frame = fn(spark, sf_dir)
    ours = frame.collect()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(frame.columns) != sorted(names):
        return len(ours), f"columns {sorted(frame.columns)} / {sorted(names)}"
    if len(ours) != len(theirs):
        return len(ours), f"{len(ours)} rows / {len(theirs)} rows"
    for a, b in zip(_rows(frame.columns, ours), _rows(names, theirs), strict=True):
        if a != b:
            return len(ours), f"{a} / {b}"
        if [type(x) for x in a] != [type(y) for y in b]:
            return len(ours), f"types of {a} / {b}"
    return len(ours), None
