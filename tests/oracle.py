"""Compare registered queries with DuckDB on the driver's smallest tables."""

import datetime
import decimal
import os

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 9)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def agree(spark, query, sql):
    df, rel = query(spark, SF), connection().sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    columns = sorted(df.columns)
    at = [rel.columns.index(c) for c in columns]
    mine = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    theirs = sorted(repr([plain(r[k]) for k in at]) for r in rel.fetchall())
    assert mine == theirs
