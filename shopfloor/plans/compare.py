"""Compare a Spark result with a DuckDB result (development and tests).

Columns are matched by name; rows are compared as multisets, floats with a
tiny relative tolerance, timestamps and dates by value.
"""

from __future__ import annotations

import datetime as _dt
import math
from decimal import Decimal

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = True  # doubles must agree bit for bit (money is exact by construction)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v if EXACT else float(f"{v:.9g}")
    if isinstance(v, Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark_df, con, sql: str, max_show: int = 5) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duckdb={d_cols}"
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    s = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=_key)
    d = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=_key)
    if len(s) != len(d):
        return False, f"row count differs: spark={len(s)} duckdb={len(d)}"
    bad = [(a, b) for a, b in zip(s, d) if a != b]
    if bad:
        lines = [f"{len(bad)} rows differ; cols={order}"]
        for a, b in bad[:max_show]:
            lines.append(f"  spark ={a}\n  duckdb={b}")
        return False, "\n".join(lines)
    return True, f"{len(s)} rows match"
