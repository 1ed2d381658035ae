"""Run a registered Spark query and its DuckDB oracle side by side.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2**53:
            return int(v)
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    import datetime as _dt
    if isinstance(v, _dt.date) and not isinstance(v, _dt.datetime):
        v = _dt.datetime(v.year, v.month, v.day)
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        v = v.replace(tzinfo=None)
    from decimal import Decimal
    if isinstance(v, Decimal):
        return round(float(v), 6)
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = Counter()
    for rec in pdf[cols].itertuples(index=False, name=None):
        out[tuple(repr(_norm(x)) for x in rec)] += 1
    return cols, out


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from cartflow.plans.catalog import ORACLE, QUERIES
    con = con or duck(sf_dir)
    sdf = QUERIES[name](spark, sf_dir).toPandas()
    res = {"name": name, "spark_rows": len(sdf)}
    if name not in ORACLE:
        res["status"] = "rows-only"
        return res
    odf = con.execute(ORACLE[name]).df()
    res["oracle_rows"] = len(odf)
    sc, srows = rows_of(sdf)
    oc, orows = rows_of(odf)
    res["columns_match"] = sc == oc
    res["values_match"] = srows == orows
    if not res["columns_match"]:
        res["spark_cols"], res["oracle_cols"] = sc, oc
    elif not res["values_match"]:
        only_s = list((srows - orows).elements())[:3]
        only_o = list((orows - srows).elements())[:3]
        res["example_spark_only"], res["example_oracle_only"] = only_s, only_o
    res["status"] = "ok" if res["columns_match"] and res["values_match"] else "MISMATCH"
    return res


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from cartflow.plans.catalog import QUERIES
    from cartflow.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(QUERIES)
    spark = get_spark("local[8]", 8)
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": "ERROR", "error": str(e)[:600]}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
