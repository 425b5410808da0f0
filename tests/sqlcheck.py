"""Runs a module's queries beside their SQL on test tables that fill every result."""

import glob
import os
from collections import Counter

import duckdb

SF = "/root/testdata/sf0.01"


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def compare(spark, query, sql):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = query(spark, SF)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = Counter(tuple(plain(r[names.index(c)]) for c in order) for r in cur.fetchall())
    got = Counter(tuple(plain(r[c]) for c in order) for r in df.collect())
    assert want and got == want
