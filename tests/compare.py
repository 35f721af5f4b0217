"""Compare a Spark result with the oracle's, order-insensitively."""

from __future__ import annotations

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    return round(v, 6) if isinstance(v, float) else v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_value(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, type(v).__name__, str(v)) for v in r)
    )


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "float": "FLOAT", "timestamp_ntz": "TIMESTAMP"}


def difference(df, con, sql: str) -> str | None:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    odd = [(n, t, types.get(n)) for n, t in df.dtypes if TYPES.get(t) != types.get(n)]
    if odd:
        return f"types differ: {odd}"
    expected = _rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(set(df.columns) ^ set(names))}"
    found = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}"
    wrong = [(a, b) for a, b in zip(found, expected) if a != b or any(type(x) is not type(y) for x, y in zip(a, b))]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
