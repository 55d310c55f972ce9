"""Local twin of the driver's correctness gate: Spark query vs DuckDB oracle SQL."""

from __future__ import annotations

import math

from tidemark.sources.driver_tables import DRIVER_TABLES, table_path


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _exact(v):
    """No tolerance: floats compared by their repr (bit-level equality)."""
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if type(v).__name__ == "Decimal":
        return repr(float(v))
    return _norm(v)


def _rows(cols, rows, exact=False):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = _exact if exact else _norm
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, sf_dir: str, name: str, query, sql: str, exact: bool = False) -> dict:
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not out["columns_match"]:
        out["spark_cols"] = sorted(s_cols)
        out["oracle_cols"] = sorted(d_cols)
        out["values_match"] = False
        return out
    a, b = _rows(s_cols, s_rows, exact), _rows(d_cols, d_rows, exact)
    out["values_match"] = a == b
    if not out["values_match"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["first_diffs"] = diff
    return out
