"""Rows of a query against the rows of its SQL in DuckDB."""

import math
import os

import duckdb


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    return v


def connect(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    return c


def assert_same(df, con, sql):
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    found = con.execute(sql)
    names = [x[0] for x in found.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in found.fetchall()), key=repr)
    assert got == want
