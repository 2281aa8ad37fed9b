"""Side-by-side check of a Spark query against its DuckDB oracle.

Mirrors the correctness gate: same row count, same column names, and the
same multiset of rows (columns sorted by name, doubles compared after
rounding, rows compared order-insensitively).
"""

from __future__ import annotations

import datetime as dt
import math
import os

# exact by default (doubles are rounded with identical IEEE steps on both
# sides); RUNLENS_EXACT_COMPARE=0 compares to 6 places instead
EXACT = os.environ.get("RUNLENS_EXACT_COMPARE", "1") == "1"

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duckdb_conn(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if EXACT else round(v, 6)
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    return v


def rows_key(columns: list[str], rows: list) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
    }
    if out["columns_match"]:
        a, b = rows_key(s_cols, s_rows), rows_key(d_cols, d_rows)
        out["values_match"] = a == b
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            out["first_diffs"] = diff
    else:
        out["values_match"] = False
        out["spark_cols"] = sorted(s_cols)
        out["oracle_cols"] = sorted(d_cols)
    out["ok"] = out["values_match"] and out["rows_spark"] == out["rows_oracle"]
    return out
