"""Compare a query with its SQL on the same Parquet files."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(root, t)}.parquet'")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, Decimal):
        return format(v, "f")
    return str(v)


def normal(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


KIND = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def difference(df, con, sql: str) -> str | None:
    """A message, or None if schema and rows agree."""
    expected = con.execute(sql)
    names = [c[0] for c in expected.description]
    types = {c[0]: str(c[1]) for c in expected.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    odd = []
    for f in df.schema.fields:
        mine = f.dataType.simpleString()
        mine = KIND.get(mine, mine.upper())
        if mine.replace(" ", "") != types[f.name].replace(" ", ""):
            odd.append(f"{f.name}: {mine} / {types[f.name]}")
    if odd:
        return "types " + ", ".join(odd)
    theirs = normal(names, expected.fetchall())
    mine = normal(df.columns, [tuple(r) for r in df.collect()])
    if mine == theirs:
        return None
    only_mine = [r for r in mine if r not in set(theirs)][:2]
    only_theirs = [r for r in theirs if r not in set(mine)][:2]
    return f"rows {len(mine)} / {len(theirs)}; only here {only_mine}; only SQL {only_theirs}; columns {sorted(names)}"
