"""Spark-vs-DuckDB result comparison (the shape of the driver's correctness gate).

Columns are sorted by name; the check is row count + column names + coarse
types + an order-insensitive comparison of the values. Only bounded results
are compared, and only in tests / the local check tool.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _kind(type_name: str) -> str:
    t = type_name.lower()
    if any(x in t for x in ("bigint", "int", "long", "short", "byte", "hugeint")):
        return "int"
    if any(x in t for x in ("double", "float", "decimal", "real")):
        return "float"
    if any(x in t for x in ("string", "varchar", "char")):
        return "string"
    if "bool" in t:
        return "bool"
    return t


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is None, str(type(x)), repr(x)) for x in row)


@dataclass
class Outcome:
    name: str
    ok: bool
    detail: str
    rows: int


def compare(name: str, spark_df, con, sql: str) -> Outcome:
    sdf = spark_df
    s_cols = sorted(sdf.columns)
    s_types = {f.name: _kind(f.dataType.simpleString()) for f in sdf.schema.fields}
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols_raw = rel.columns
    d_types = {c: _kind(str(t)) for c, t in zip(d_cols_raw, rel.types)}
    d_cols = sorted(d_cols_raw)
    idx = [d_cols_raw.index(c) for c in d_cols]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    if s_cols != d_cols:
        return Outcome(name, False, f"columns spark={s_cols} duckdb={d_cols}", len(s_rows))
    bad_types = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    if bad_types:
        return Outcome(name, False, f"types {bad_types}", len(s_rows))
    if len(s_rows) != len(d_rows):
        return Outcome(name, False, f"rows spark={len(s_rows)} duckdb={len(d_rows)}", len(s_rows))
    a = sorted(s_rows, key=_key)
    b = sorted(d_rows, key=_key)
    for x, y in zip(a, b):
        if x != y:
            return Outcome(name, False, f"value spark={x} duckdb={y}", len(s_rows))
    return Outcome(name, True, "ok", len(s_rows))
