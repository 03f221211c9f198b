"""Runs a query's SQL in DuckDB and brings both results to one form."""

import decimal
import math
import os

import duckdb


def norm(v):
    if v is None:
        return None
    if hasattr(v, "item") and getattr(v, "ndim", 0) == 0:
        v = v.item()
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return str(v) if isinstance(v, (list, dict)) else v


def table(rows, columns):
    return sorted((tuple(norm(r[c]) for c in columns) for r in rows), key=lambda t: tuple((v is None, str(type(v)), str(v)) for v in t))


def duck(sf, sql):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{f}'")
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    return [dict(zip(names, row, strict=True)) for row in got.fetchall()], names


def same(spark, sf, query, sql):
    df = query(spark, sf)
    columns = sorted(df.columns)
    want, names = duck(sf, sql)
    assert sorted(names) == columns
    assert table(df.collect(), columns) == table(want, columns)
