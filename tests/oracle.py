"""Queries against their SQL in DuckDB: same rows, columns and values."""

import math
import os

import duckdb


def tables(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def plain(x):
    if hasattr(x, "as_tuple"):
        x = float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    return str(x)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def compare(spark, con, query, sql, sf_dir):
    """None, or what differs."""
    got = query(spark, sf_dir)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows(names, cursor.fetchall())
    have = rows(got.columns, got.collect())
    if sorted(names) != sorted(got.columns):
        return f"columns {sorted(got.columns)} and {sorted(names)}"
    if have != want:
        odd = next(((a, b) for a, b in zip(have, want, strict=False) if a != b), None)
        return f"{len(have)} and {len(want)} rows, first difference {odd}"
    kinds = dict(zip(names, [str(d[1]) for d in cursor.description], strict=True))
    number = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT"}
    odd = {n: (t, kinds[n]) for n, t in got.dtypes if t in number and not kinds[n].upper().startswith((number[t], "NUMBER", "STRING", "BOOL"))}
    return f"types {odd}" if odd else None
