"""Runs a registered query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_norm(r[i]) for i in order] for r in data), key=repr)


def duck(sql, sf=SF):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    return cols, rel.fetchall()


def assert_same(spark, query, sql, sf=SF):
    df = query(spark, sf)
    cols, want = duck(sql, sf)
    assert sorted(df.columns) == sorted(cols)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    want = rows(cols, want)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g == w
