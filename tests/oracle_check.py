"""Run a registered query in Spark and its SQL in DuckDB; compare the results.

Mirrors the external check: same row count, same column names, and the same
multiset of rows (floats compared after rounding to 6 significant decimals).
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.6g}") if math.isfinite(v) else v
    if isinstance(v, pd.Timestamp) and v == v.normalize():
        return v.date().isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return sorted(out, key=repr)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from snapweave.oracle import ORACLE
    from snapweave.registry import QUERIES

    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir).toPandas()
    t1 = time.time()
    res = {"name": name, "spark_rows": len(sdf), "spark_s": round(t1 - t0, 2)}
    if name not in ORACLE:
        res["oracle"] = None
        return res
    con = con or duck(sf_dir)
    ddf = con.execute(ORACLE[name]).df()
    res["oracle_rows"] = len(ddf)
    res["cols_match"] = sorted(sdf.columns) == sorted(ddf.columns)
    if not res["cols_match"]:
        res["cols"] = (sorted(sdf.columns), sorted(ddf.columns))
        return res
    a, b = rows_of(sdf), rows_of(ddf)
    res["match"] = a == b
    if not res["match"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = [r for r in a if r not in sb][:3]
        res["only_oracle"] = [r for r in b if r not in sa][:3]
    return res


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from snapweave.registry import QUERIES
    from snapweave.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_session()
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and go on
            r = {"name": n, "error": repr(e)[:600]}
        ok = r.get("match") or (r.get("oracle", 1) is None and "error" not in r)
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print("failures:", bad)
