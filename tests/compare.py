"""Run a registered query next to its SQL and compare the rows as multisets."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(df, sql: str, con: duckdb.DuckDBPyConnection) -> list[str]:
    """Empty when both give the same columns and rows."""
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = multiset(want_columns, cursor.fetchall())
    have = multiset(df.columns, [tuple(r) for r in df.collect()])
    found = []
    if sorted(df.columns) != sorted(want_columns):
        found.append(f"columns {sorted(df.columns)} / {sorted(want_columns)}")
    if sum(have.values()) != sum(want.values()):
        found.append(f"rows {sum(have.values())} / {sum(want.values())}")
    if have != want:
        found.append(f"only Spark: {list((have - want))[:3]}, only SQL: {list((want - have))[:3]}")
    return found
