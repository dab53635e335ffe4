"""Spark result against DuckDB oracle: row count, column names and types, values."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Spark type name -> DuckDB type name of the same values.
TYPE_MAP = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER",
            "boolean": "BOOLEAN", "double": "DOUBLE"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def compare(df, con, sql: str) -> tuple[bool, str]:
    rel = con.sql(sql)
    dcols = [c for c in rel.columns]
    dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    drows = rel.fetchall()
    scols = df.columns
    stypes = dict(df.dtypes)
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ: {sorted(scols)} vs {sorted(dcols)}"
    for c in scols:
        if TYPE_MAP.get(stypes[c], stypes[c]) != dtypes[c]:
            return False, f"type of {c}: spark {stypes[c]} vs duckdb {dtypes[c]}"
    order = sorted(scols)
    srows = [tuple(_norm(r[c]) for c in order) for r in df.collect()]
    didx = [dcols.index(c) for c in order]
    drows = [tuple(_norm(r[i]) for i in didx) for r in drows]
    key = lambda t: tuple((x is None, str(x)) for x in t)
    srows.sort(key=key)
    drows.sort(key=key)
    if len(srows) != len(drows):
        return False, f"row count {len(srows)} vs {len(drows)}"
    for a, b in zip(srows, drows):
        if a != b:
            return False, f"first difference: {a} vs {b}"
    return True, f"{len(srows)} rows"
