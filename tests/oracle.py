"""Run a query in Spark and its SQL in DuckDB over the same tables, and compare the rows."""

from __future__ import annotations

import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, bytes | bytearray):
        return bytes(v)
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    return v


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def compare(df, con, sql):
    got = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in got.description}
    names = sorted(kinds)
    assert sorted(df.columns) == names
    order = [list(kinds).index(n) for n in names]
    want = sorted((tuple(plain(r[i]) for i in order) for r in got.fetchall()), key=repr)
    have = sorted((tuple(plain(v) for v in r) for r in df.select(*(f"`{n}`" for n in names)).collect()), key=repr)
    assert len(have) == len(want), (len(have), len(want))
    assert have == want, next((a, b) for a, b in zip(have, want, strict=True) if a != b)
    real = dict(con.execute(f"select column_name, column_type from (describe {sql})").fetchall())
    wrong = {n: (k, real[n]) for n, k in df.dtypes if KINDS.get(k, k) != real[n] and not k.startswith("array")}
    assert not wrong, wrong
    return len(have)


