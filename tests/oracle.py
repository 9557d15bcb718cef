"""Runs a query in Spark and its SQL in DuckDB and compares the rows."""

from __future__ import annotations

import datetime
import os
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (Decimal, float)):
        return None if v != v else float(v) + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in values], key=repr)


def compare(spark, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    assert sorted(df.columns) == sorted(names), (name, df.columns, names)
    assert len(got) == len(want), (name, len(got), len(want))
    bad = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
    assert not bad, (name, len(bad), bad[:2])
    return len(got)
