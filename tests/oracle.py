"""Runs a query and its SQL over one folder and compares their rows."""

import datetime
import decimal
import glob
import os

import duckdb

FOLDER = "/root/testdata/sf0.001"


def plain(v):
    if v is None or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, float):
        return round(v, 5)
    if isinstance(v, decimal.Decimal):
        return int(v) if v == int(v) else round(float(v), 5)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def connection(folder=FOLDER):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in glob.glob(folder + "/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def both(spark, query, sql, folder=FOLDER):
    df = query(spark, folder)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    r = connection(folder).execute(sql)
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(row[names.index(c)]) for c in cols) for row in r.fetchall()), key=repr)
    return got, want
