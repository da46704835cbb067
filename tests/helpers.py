"""A folder's queries held against their SQL."""

import glob
import os

import duckdb

FOLDER = "/root/testdata/sf0.001"


def connect(folder: str = FOLDER):
    con = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def rows(df):
    names = sorted(df.columns)
    return sorted((tuple(map(repr, (r[c] for c in names))) for r in df.collect()))


def sql_rows(con, sql):
    r = con.sql(sql)
    at = sorted(range(len(r.columns)), key=lambda i: r.columns[i])
    return sorted(tuple(repr(x[i]) for i in at) for x in r.fetchall()), sorted(r.columns)
