"""Side-by-side check of a registered Spark query and its DuckDB oracle.

Mirrors the driver's gate: same column names, same row count, and the
same multiset of rows (columns sorted by name, floats to 6 places).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from cairn.sources.tables import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x) if not isinstance(x, tuple) else (False, "t", str(x)) for x in row)


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float"}


def _spark_type(duck_type: str) -> str:
    if duck_type.endswith("[]"):
        return "array<" + _spark_type(duck_type[:-2]) + ">"
    return DUCK_TO_SPARK.get(duck_type, duck_type.lower())


def compare(df, con, sql: str) -> tuple[bool, str]:
    s_cols = df.columns
    s_types = dict(df.dtypes)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    o_cols = list(rel.columns)
    o_types = {c: _spark_type(str(t)) for c, t in zip(rel.columns, rel.types)}
    o_rows = rel.fetchall()
    if sorted(s_cols) != sorted(o_cols):
        return False, f"columns differ: spark={sorted(s_cols)} oracle={sorted(o_cols)}"
    tdiff = [(c, s_types[c], o_types[c]) for c in s_cols if s_types[c] != o_types[c]]
    if tdiff:
        return False, f"types differ (column, spark, oracle): {tdiff}"
    if len(s_rows) != len(o_rows):
        return False, f"row count differs: spark={len(s_rows)} oracle={len(o_rows)}"
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    oi = [o_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in oi) for r in o_rows), key=_key)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first differing row (cols {order}):\n spark ={x}\n oracle={y}"
    return True, f"{len(a)} rows"
