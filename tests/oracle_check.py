"""Run every registered query in Spark and its oracle SQL in DuckDB and compare
row count, column names and values (order-insensitive).

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402
from strata.sources.testdata import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _arrow(res):
    import warnings
    warnings.simplefilter("ignore")
    for attr in ("to_arrow_table", "fetch_arrow_table", "arrow"):
        if hasattr(res, attr):
            t = getattr(res, attr)()
            return t.read_all() if hasattr(t, "read_all") else t
    raise RuntimeError("no arrow result")


def norm(v):
    if v is None:
        return None
    if isinstance(v, float | np.floating):
        if math.isnan(v):
            return None
        return repr(float(v))
    if isinstance(v, np.integer | int) and not isinstance(v, bool):
        return str(int(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, pd.Timestamp | dt.datetime):
        return pd.Timestamp(v).tz_localize(None).isoformat() if pd.Timestamp(v).tzinfo else pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, list | tuple | np.ndarray):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if v is pd.NaT:
        return None
    return str(v)


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(norm(None if (not isinstance(x, list | tuple | np.ndarray | dict) and pd.isna(x)) else x)
                         for x in rec))
    return sorted(out, key=repr)


def compare(name: str, sdf: pd.DataFrame, odf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(sdf.columns) != sorted(odf.columns):
        return False, f"columns differ: {sorted(sdf.columns)} vs {sorted(odf.columns)}"
    if len(sdf) != len(odf):
        return False, f"rows {len(sdf)} vs {len(odf)}"
    a, b = rows(sdf), rows(odf)
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if bad:
        return False, f"{len(bad)} differing rows, e.g. spark={bad[0][0]} oracle={bad[0][1]}"
    return True, f"{len(sdf)} rows equal"


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from strata.session import get_session
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    failed = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        sdf = fn(spark, sf_dir).toPandas()
        t1 = time.time()
        if name not in oracle:
            print(f"{name:32s} NO-ORACLE rows={len(sdf)} spark={t1 - t0:.1f}s", flush=True)
            continue
        try:
            odf = _arrow(con.execute(oracle[name])).to_pandas(date_as_object=True)
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} ORACLE-ERROR {str(e)[:400]}", flush=True)
            failed += 1
            continue
        ok, msg = compare(name, sdf, odf)
        failed += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} {msg} spark={t1 - t0:.1f}s", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
