"""Holds a query's rows against its SQL in DuckDB."""

import os
from decimal import Decimal

import duckdb

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(v):
    if isinstance(v, Decimal):
        return float(v)
    return 0.0 if isinstance(v, float) and v == 0 else v


def assert_same(df, sql, sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    rel = c.sql(sql)
    names = sorted(df.columns)
    assert names == sorted(rel.columns)
    want = [{n: _plain(v) for n, v in zip(rel.columns, r)} for r in rel.fetchall()]
    got = [{n: _plain(v) for n, v in r.items()} for r in df.toArrow().to_pylist()]
    want, got = sorted(([r[n] for n in names] for r in want), key=repr), sorted(([r[n] for n in names] for r in got), key=repr)
    assert len(want) == len(got)
    for w, g in zip(want, got):
        assert w == g
