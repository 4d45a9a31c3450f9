"""Spark rows against DuckDB rows, as the driver compares them: columns by name, rows in any order."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

SF = os.environ.get("LODEPLANE_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else int(v) if v == int(v) else v
    if isinstance(v, datetime.datetime) and v.time() == datetime.time() and v.tzinfo is None:
        return v.date()
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def from_spark(df):
    return rows(df.columns, df.collect())


def from_duckdb(sql, sf_dir=SF):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    out = con.execute(sql)
    return rows([d[0] for d in out.description], out.fetchall())
