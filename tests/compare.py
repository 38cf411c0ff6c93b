"""Run catalog queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


SPARK_KIND = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
SPARK_KIND |= {"timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def mismatch(df, con, sql) -> str | None:
    """None when both sides agree exactly, else what differs."""
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = _rows(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    kinds = {f.name: SPARK_KIND.get(f.dataType.simpleString(), "?") for f in df.schema.fields}
    theirs = {c: str(t) for c, t in zip(rel.columns, rel.types, strict=True)}
    if kinds != theirs:
        return f"types {[(c, kinds[c], theirs[c]) for c in kinds if kinds[c] != theirs[c]]}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if got != want:
        bad = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
        return f"{len(bad)} rows differ, first: {bad[0]}"
    return None
