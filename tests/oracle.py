"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())


def differences(df, con, sql) -> str:
    """Empty if both agree in columns and rows, any order."""
    names, got = spark_rows(df)
    want_names, want = duck_rows(con, sql)
    if names != want_names:
        return f"columns {names} != {want_names}"
    if got != want:
        extra, missing = got - want, want - got
        return (f"{sum(got.values())} rows vs {sum(want.values())}; only spark {list(extra.items())[:3]}; "
                f"only sql {list(missing.items())[:3]}")
    return ""
