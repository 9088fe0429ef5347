"""Runs a query and its SQL on one scale and compares the rows, column by column name."""

import glob
import os

import duckdb
import numpy as np

DATA = os.environ.get("SILTWORKS_TESTDATA", "/root/testdata")


def text(v) -> str:
    if v is None or (isinstance(v, float) and np.isnan(v)):
        return "NULL"
    if isinstance(v, (float, np.floating)):
        return repr(float(v))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(text, v)) + "]"
    return str(v)


def rows(columns, data) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(text(r[i]) for i in order) for r in data)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return con


def check(spark, query, sql: str, sf_dir: str) -> None:
    got = query(spark, sf_dir)
    res = connect(sf_dir).execute(sql)
    want = [c[0] for c in res.description]
    assert sorted(got.columns) == sorted(want)
    assert rows(got.columns, got.collect()) == rows(want, res.fetchall())
