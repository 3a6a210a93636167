"""Side-by-side check of a registered query against its DuckDB oracle.

Used by the tests and by hand while developing; it mirrors the driver's check
(row count, column names, order-insensitive values).  Results are brought to
the driver, so it is meant for the small test scales only.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

from pyspark.sql import SparkSession

from tripledger.sources.testdata import TABLES


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(
            f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')"
        )
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                         for x in r))


def compare(spark: SparkSession, name: str, query, sql: str, sf_dir: str, con=None) -> dict:
    """Run both sides; report row counts, column names and value equality."""
    con = con or duckdb_connection(sf_dir)
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    result = {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_columns": s_cols,
        "oracle_columns": d_cols,
    }
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    result["values_match"] = result["columns_match"] and a == b
    if not result["values_match"] and result["columns_match"]:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        result["sample_spark_only"] = diff_a
        result["sample_oracle_only"] = diff_b
    return result
